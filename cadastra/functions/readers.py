"""Readers of loosely typed text as native columns: bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space in source texts.
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def text(value: Column) -> Column:
    """Trimmed text; blank gives null."""
    return F.nullif(F.regexp_replace(value, f"^{SPACE}+|{SPACE}+$", ""), F.lit(""))


def number(value: Column) -> Column:
    """A finite decimal number, dollar signs and commas ignored; hexadecimal and named values give null."""
    plain = text(F.regexp_replace(value, "[$,]", ""))
    read = F.when(plain.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), plain.try_cast("double"))
    return F.when(F.abs(read) < F.lit(float("inf")), read)


def integer(value: Column) -> Column:
    """``number`` cut toward zero; null beyond 64 bits."""
    read = number(value)
    return F.when(F.abs(read) < 9.2e18, read.try_cast("bigint"))


def plain_decimal(value: Column, kind: str = "decimal(38,10)") -> Column:
    """Only optional minus, digits and one point; exponents, names and type suffixes give null."""
    return F.when(value.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), value.try_cast(kind))


def boolean(value: Column) -> Column:
    word = F.lower(text(value))
    return F.when(word.isin("true", "yes", "y", "1"), True).when(word.isin("false", "no", "n", "0"), False)


def texts(values: Column) -> Column:
    """Trimmed entries without blanks; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(values, text), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def _day(year: Column, month: Column, day: Column) -> Column:
    whole = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(year.cast("int") >= 100, F.try_to_timestamp(whole, F.lit("yyyy-MM-dd")).cast("date"))


def date(value: Column) -> Column:
    """A text that begins with yyyy-MM-dd or is M/d/yyyy, if the calendar has that day."""

    def read(t: Column) -> Column:
        iso, us = r"^(\d{4})-(\d{2})-(\d{2})", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
        part = lambda p, k: F.regexp_extract(t, p, k)
        return F.when(t.rlike(iso), _day(part(iso, 1), part(iso, 2), part(iso, 3))).when(t.rlike(us), _day(part(us, 3), part(us, 1), part(us, 2)))

    return let(text(value), read)


#: Layouts of time stamps beside ISO 8601.
STAMPS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def timestamp(value: Column) -> Column:
    """An instant from ISO 8601 or a listed layout; texts without a zone are taken as UTC, in sessions that run on UTC."""
    t = text(value)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}.*)?$"), t.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(t, F.lit(x)) for x in STAMPS])


def compact_date(value: Column) -> Column:
    """(day, issue) of CCYYMMDD: all zeros or all nines mean no date, other strings that are no day are an issue."""
    none = value.rlike("^0+$") | value.rlike("^9+$") | value.isNull()
    day = F.when(value.rlike(r"^\d{8}$"), _day(F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2)))
    return F.struct(F.when(~none, day).alias("day"), F.when(~none & day.isNull(), F.lit("invalid_calendar_date")).alias("issue"))


def zip9(value: Column) -> Column:
    """(zip, plus_four) of nine digits; zeros only mean none."""
    zip5, four = F.substring(value, 1, 5), F.substring(value, 6, 4)
    some = ~value.rlike("^0+$")
    return F.struct(F.when(some, zip5).alias("zip"), F.when(some & ~four.rlike("^0+$"), four).alias("plus_four"))
