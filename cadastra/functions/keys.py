"""Pure normalisers of names, addresses and dates as native columns; bad input gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Street suffixes and their short forms.
SUFFIXES = {"STREET": "ST", "AVENUE": "AVE", "ROAD": "RD", "DRIVE": "DR", "LANE": "LN", "COURT": "CT", "BOULEVARD": "BLVD"}


def digits(value: Column) -> Column:
    """The digits of ``value``; null if there are none."""
    return F.nullif(F.regexp_replace(value, "[^0-9]", ""), F.lit(""))


def name_key(value: Column) -> Column:
    """Upper-case letters and digits only, so spellings that differ in marks and spaces meet."""
    return F.nullif(F.upper(F.regexp_replace(value, "[^A-Za-z0-9]+", "")), F.lit(""))


def address(value: Column) -> Column:
    """Upper case, marks to single spaces, short suffixes."""
    out = F.trim(F.regexp_replace(F.upper(value), "[^A-Z0-9]+", " "))
    for long, short in SUFFIXES.items():
        out = F.regexp_replace(out, rf"\b{long}\b", short)
    return F.nullif(out, F.lit(""))


def street_base(value: Column) -> Column:
    """An address without its unit."""
    return F.regexp_replace(address(value), r" (?:APT|UNIT|STE) .*$", "")


def us_date(value: Column) -> Column:
    """``MM/dd/yyyy`` to a date; anything else gives null."""
    return F.try_to_timestamp(value, F.lit("MM/dd/yyyy")).cast("date")
