"""Names of persons, companies, counties and sources as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .readers import text


def name(value: Column) -> Column:
    """Upper case, letters and digits with single blanks; null only for blank text."""
    return F.trim(F.regexp_replace(F.upper(text(value)), "[^A-Z0-9]+", " "))


def joined_key(value: Column) -> Column:
    """Lower-case letters and digits only; null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]", "")


def contractor(value: Column) -> Column:
    """Lower case, ``&`` as and, company words in one form, other marks as blanks; null counts as empty."""
    out = F.replace(F.lower(F.coalesce(value, F.lit(""))), F.lit("&"), F.lit(" and "))
    for pattern, new in ((r"\b(?:corporation|company|corp\.?|co\.?)\b", "co"), (r"\binc\.\b", "inc"), (r"\bl\.l\.c\.\b", "llc")):
        out = F.regexp_replace(out, pattern, new)
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def canonical_contractor(value: Column) -> Column:
    """``name`` with U S as US and without AND."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(name(value), r"\bU S\b", "US"), r"\bAND\b", " "), r"\s+", " "))


def _slug(county: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(county)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def appraisal_source(county: Column) -> Column:
    return F.when(F.endswith(_slug(county), F.lit("_appraiser")), _slug(county)).otherwise(F.concat(_slug(county), F.lit("_appraiser")))


def permit_prefix(county: Column) -> Column:
    return F.regexp_replace(appraisal_source(county), "_appraiser$", "")


def county_of_jurisdiction(key: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(key)), "_appraiser$", ""), "_+", "-"), "^-+|-+$", "")


#: Where the county stands in the artifact addresses of each source.
COUNTY_IN_URI = {"sunbiz": r"(?i)sunbiz-(.+?)-corporate", "overture_places": r"(?i)overture-places/([^/]+)", "bbb": r"(?i)category-data/([^/]+)"}


def county_of_uri(source: str, uri: Column) -> Column:
    found = F.trim(F.lower(F.regexp_extract(uri, COUNTY_IN_URI[source], 1)))
    return F.nullif(F.regexp_replace(found, "-county.*$", "") if source == "bbb" else found, F.lit(""))


def s3_uri(uri: Column) -> Column:
    """(bucket, key) of ``s3://bucket/key``, the key decoded; null for other addresses."""
    pattern = r"^s3://([^/?#]+)/?([^?#]*)"
    # A plus sign stands for itself in a path.
    key = F.url_decode(F.replace(F.regexp_extract(uri, pattern, 2), F.lit("+"), F.lit("%2B")))
    return F.when(uri.rlike(pattern), F.struct(F.lower(F.regexp_extract(uri, pattern, 1)).alias("bucket"), key.alias("key")))
