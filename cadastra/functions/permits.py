"""Permit texts: status, keywords, documents, licences and fees as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import readers

STATUS_CHARS = 256
#: Words of the portal page that end a status.
_CHROME = r"(?i)\s+(?:Click here for more information|Create a New Collection|Add to Existing Collection|Record Info|Record Details|Processing Status|Related Records|Work Location)\b.*$"
#: Keywords of industrial use and their patterns.
INDUSTRIAL = {
    "industrial": r"\bindustrial\b",
    "warehouse": r"\bware\s*house\b|\bwarehouse\b",
    "distribution": r"\bdistribution\b|\blogistics\b",
    "manufacturing": r"\bmanufactur(?:e|ing|er)\b",
    "factory": r"\bfactory\b",
    "plant": r"\b(?:processing|production|industrial)\s+plant\b",
    "fabrication": r"\bfabricat(?:e|ion|or)\b",
    "cold storage": r"\bcold\s+storage\b",
    "self storage": r"\bself[-\s]?storage\b|\bmini[-\s]?warehouse\b",
    "truck terminal": r"\btruck(?:ing)?\s+terminal\b|\bfreight\s+terminal\b",
    "flex industrial": r"\bflex\s+industrial\b",
}
#: Parts of addresses that lead to a document, as the loader and as the selection in SQL know them.
DOCUMENT_MARKS = (".pdf", "urlrouting.ashx", "digitalprojects", "/documents/", "showdocument", "documentdownload")


def joined(*fields: Column) -> Column:
    """The non-blank fields, trimmed and joined by blanks."""
    return F.concat_ws(" ", *[readers.text(f) for f in fields])


def status(value: Column) -> Column:
    """The status in front of portal text, at most STATUS_CHARS long."""
    whole = F.regexp_replace(readers.text(value), rf"{readers.SPACE}+", " ")
    return F.nullif(F.rtrim(F.substring(F.trim(F.regexp_replace(whole, _CHROME, "")), 1, STATUS_CHARS)), F.lit(""))


def industrial_keywords(*fields: Column) -> Column:
    """Keywords of industrial use in the joined fields, in the order of the table."""
    return readers.let(joined(*fields), lambda t: F.array_compact(F.array(*[F.when(t.rlike(f"(?i){p}"), F.lit(k)) for k, p in INDUSTRIAL.items()])))


def is_commercial(number: Column, *fields: Column) -> Column:
    return F.coalesce(F.startswith(F.upper(readers.text(number)), F.lit("COM")), F.lit(False)) | F.contains(F.upper(joined(*fields)), F.lit("COMMERCIAL"))


def is_live(*fields: Column) -> Column:
    """Neither void nor a test."""
    return readers.let(F.upper(joined(*fields)), lambda t: ~F.contains(t, F.lit("VOID")) & ~F.contains(t, F.lit("TEST")))


def is_document(url: Column, marks: tuple[str, ...] = DOCUMENT_MARKS) -> Column:
    low = F.lower(readers.text(url))
    known = F.lit(False)
    for m in marks:
        known = known | F.contains(low, F.lit(m))
    return F.coalesce(low.rlike("^https?://") & known, F.lit(False))


#: Caps and weights of the terms of a candidate's score.
SCORE_TERMS = (("commercial", 20, 45), ("live", 30, 20), ("inspections", 20, 6), ("contacts", 20, 4), ("documents", 20, 8), ("links", 30, 1), ("registrations", 20, 35), ("address_permits", 20, 12))


def candidate_score(counts: dict[str, Column]) -> Column:
    out = F.lit(1000)
    for term, cap, weight in SCORE_TERMS:
        out = out + F.least(counts[term], F.lit(cap)) * weight
    return out.cast("bigint")


def usage_score(usage: Column, permits: Column) -> Column:
    return (F.when(usage == "LightManufacturing", 120).otherwise(100) + permits).cast("bigint")


def fees(raw: Column) -> Column:
    """Fee lines of a page's text: code, amount, day and the status of the nearest heading in the 240 characters before."""
    line = r"(?i)(\d{1,2}/\d{1,2}/\d{4})\s+([A-Z0-9-]+)\s+\$?([\d,]+(?:\.\d{2})?)\s+View Details"
    found, pieces = F.regexp_extract_all(raw, F.lit(line), F.lit(0)), F.split(raw, line)
    start = F.struct(F.lit("").alias("before"), F.array().cast("array<struct<code:string,amount:double,day:date,status:string>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        before = F.concat(a["before"], x["piece"])
        near = F.lower(F.right(before, F.lit(240)))
        kind = F.when(F.contains(near, F.lit("paid / discounted")) | F.contains(near, F.lit("paid fees")), "PAID_OR_DISCOUNTED").when(F.contains(near, F.lit("outstanding")), "OUTSTANDING").otherwise("UNKNOWN")
        part = lambda k: F.regexp_extract(x["line"], line, k)
        fee = F.struct(part(2).alias("code"), readers.number(part(3)).alias("amount"), readers.date(part(1)).alias("day"), kind.alias("status"))
        return F.struct(F.right(F.concat(before, x["line"]), F.lit(240)).alias("before"), F.concat(a["out"], F.array(fee)).alias("out"))

    zipped = F.filter(F.arrays_zip(pieces.alias("piece"), found.alias("line")), lambda x: x["line"].isNotNull())
    return F.aggregate(zipped, start, step, lambda a: a["out"])


def fee_total(lines: Column) -> Column:
    amounts = F.filter(F.transform(lines, lambda x: x["amount"]), lambda x: x.isNotNull())
    return F.when(F.size(amounts) > 0, F.round(F.aggregate(amounts, F.lit(0.0), lambda a, x: a + x), 2))
