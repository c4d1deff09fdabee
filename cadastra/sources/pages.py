"""Links and labelled values of web pages, by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATTRIBUTE = r"""(?i)\b(?:src|href)\s*=\s*["']([^"']+)["']"""


def decoded(value: Column) -> Column:
    """Character references that addresses hold."""
    for name, char in (("&#38;", "&"), ("&#39;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = F.replace(value, F.lit(name), F.lit(char))
    return value


def absolute(url: Column, page: Column) -> Column:
    """An address as seen from a page: whole, from the scheme, from the host, or beside the page; null for other schemes."""
    host, folder = F.regexp_extract(page, r"^(https?://[^/?#]+)", 1), F.regexp_extract(page, r"^(https?://[^?#]*/)", 1)
    beside = F.when(folder == "", F.concat(host, F.lit("/"))).otherwise(folder)
    return (
        F.when(url.rlike("(?i)^https?://"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(page, "^(https?:)", 1), url))
        .when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(url.startswith("/"), F.concat(host, url))
        .when(~url.startswith("#"), F.concat(beside, F.regexp_replace(url, r"^(?:\./)+", "")))
    )


def links(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """(key, link, at) of every address in the attributes of a page, in order."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(ATTRIBUTE), F.lit(1))
    rows = pages.select(key, F.col(url).alias("_page"), F.posexplode(found).alias("at", "raw"))
    return rows.select(key, absolute(F.trim(decoded(F.col("raw"))), F.col("_page")).alias("link"), "at").where("link is not null")


def widest(found: DataFrame, key: str, link: str = "link", at: str = "at") -> DataFrame:
    """Of links that differ in their width parameter only, the widest one; of equal widths the first."""
    width = F.regexp_extract(link, r"(?i)[?&](?:width|w)=([0-9]+)", 1).try_cast("bigint")
    same = F.regexp_replace(F.regexp_replace(link, r"(?i)([?&])(?:width|w)=[0-9]+&?", "$1"), "[?&]$", "")
    w = Window.partitionBy(key, "identity").orderBy(F.coalesce("width", F.lit(0)).desc(), at)
    return found.withColumns({"identity": same, "width": width}).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def labelled(html: Column, label: str) -> Column:
    """The text of the element behind a label, tags removed; null without it."""
    raw = F.regexp_extract(html, rf"(?is){label}\s*:?\s*(?:</[^>]+>\s*)*(?:<[^>]+>\s*)*([^<]+)", 1)
    return F.nullif(F.trim(F.regexp_replace(decoded(raw), r"\s+", " ")), F.lit(""))
