"""Fixed-width text: a layout of (name, width, type) renders rows to lines and parses them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions import readers

Layout = list[tuple[str, int, str]]


def render(df: DataFrame, layout: Layout) -> DataFrame:
    """One column ``value``; null is blank, longer values are refused rather than cut."""
    cells = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _, _ in layout]
    fits = [F.when(F.length(c) > w, F.raise_error(F.lit(f"{n} is wider than {w}"))).otherwise(F.rpad(c, w, " ")) for c, (n, w, _) in zip(cells, layout)]
    return df.select(F.concat(*fits).alias("value"))


def parse(lines: DataFrame, layout: Layout) -> DataFrame:
    """Typed columns of ``value``; blank or malformed cells are null."""
    out, at = [], 1
    for name, width, kind in layout:
        cell = F.nullif(F.trim(F.substring("value", at, width)), F.lit(""))
        out.append(cell.try_cast(kind).alias(name))
        at += width
    return lines.select(*out)


@dataclass(frozen=True)
class Component:
    """A fixed-width file: lines of ``width`` characters with fields (name, first, last, kind), kind text, numeric or date.

    With ``controls`` the first line is a header and the last one a trailer that ends in the count of data lines.
    """

    name: str
    width: int
    fields: tuple[tuple[str, int, int, str], ...]
    key: str
    controls: bool = True


def read_component(lines: DataFrame, spec: Component) -> DataFrame:
    """Typed columns of every data line of (file, line, value) with ``reject``, the first reason that the line is refused, or null.

    Short lines are filled up with blanks, longer ones refused; a numeric field holds digits only or blanks, a date CCYYMMDD,
    zeros or nines only.  A value of a refused field is null.
    """
    ends = lines.groupBy("file").agg(F.min("line").alias("_first"), F.max("line").alias("_last"))
    data = lines.join(ends, "file").where((F.col("line") > F.col("_first")) & (F.col("line") < F.col("_last"))).drop("_first", "_last") if spec.controls else lines
    row = F.rpad("value", spec.width, " ")
    columns, faults = [], [F.when(F.length("value") > spec.width, "too_long")]
    for name, first, last, kind in spec.fields:
        raw = F.substring(row, first, last - first + 1)
        cell = F.nullif(F.trim(raw), F.lit(""))
        if kind == "date":
            read = readers.compact_date(cell)
            columns.append(read["day"].alias(name))
            faults.append(F.when(read["issue"].isNotNull(), f"{name}: {kind}"))
        elif kind == "numeric":
            good = cell.rlike(r"^[0-9]+$")
            columns.append(F.when(good, cell).alias(name))
            faults.append(F.when(~good, f"{name}: {kind}"))
        else:
            columns.append(cell.alias(name))
    missing = F.when(F.trim(F.substring(row, *[(f, n - f + 1) for c, f, n, _ in spec.fields if c == spec.key][0])) == "", f"{spec.key}: missing")
    return data.select("file", "line", *columns, F.coalesce(*faults, missing).alias("reject"))


def control_report(lines: DataFrame, spec: Component, digits: int = 8) -> DataFrame:
    """(file, lines, stated, ok): the data lines of each file against the count at the end of its trailer."""
    counted = lines.groupBy("file").agg(F.count("*").alias("n"), F.max_by("value", "line").alias("trailer"), F.max(F.length("value")).alias("widest"))
    stated = F.regexp_extract("trailer", rf"([0-9]{{{digits}}})\s*$", 1).try_cast("bigint")
    return counted.select("file", (F.col("n") - 2).alias("lines"), stated.alias("stated"), F.coalesce((F.col("n") >= 2) & (stated == F.col("n") - 2) & (F.col("widest") <= spec.width), F.lit(False)).alias("ok"))


def groups(rows: DataFrame, key: str) -> DataFrame:
    """(file, key, n, in_order): rows per key and whether no smaller key stands in front of the group's first line."""
    w = Window.partitionBy("file").orderBy("line")
    ordered = rows.withColumn("_back", F.coalesce(F.col(key) < F.lag(key).over(w), F.lit(False)))
    return ordered.groupBy("file", key).agg(F.count("*").alias("n"), (~F.bool_or("_back")).alias("in_order"))


#: Components of the corporation files, by position.
ASSUMED_OLD_NAME = Component(
    "assumed_old_name", 222,
    (("file_number", 1, 8, "numeric"), ("cancellation_date", 9, 16, "date"), ("current_date", 17, 24, "date"), ("assumed_old_indicator", 25, 25, "numeric"), ("assumed_old_date", 26, 33, "date"), ("assumed_old_name", 34, 222, "text")),
    "file_number",
)
STOCK = Component(
    "stock", 101,
    (("file_number", 1, 8, "numeric"), ("stock_class", 9, 33, "text"), ("stock_series", 34, 58, "text"), ("voting_rights", 59, 59, "text"), ("authorized_shares", 60, 72, "numeric"), ("issued_shares", 73, 88, "numeric"), ("par_value", 89, 101, "numeric")),
    "file_number",
)
ANNUAL_REPORT = Component(
    "annual_report", 126,
    (
        ("file_number", 1, 8, "numeric"), ("current_factor", 9, 15, "numeric"), ("current_paid_amount", 16, 24, "numeric"), ("current_annual_report_capital", 25, 35, "numeric"), ("current_delinquent_run_date", 36, 43, "date"),
        ("current_run_date", 44, 51, "date"), ("current_paid_batch_number", 52, 55, "numeric"), ("current_paid_batch_year", 56, 59, "numeric"), ("current_paid_date", 60, 67, "date"), ("previous_factor", 68, 74, "numeric"),
        ("previous_paid_amount", 75, 83, "numeric"), ("previous_capital", 84, 94, "numeric"), ("previous_delinquent_run_date", 95, 102, "date"), ("previous_run_date", 103, 110, "date"), ("previous_paid_batch_number", 111, 114, "numeric"),
        ("previous_paid_batch_year", 115, 118, "numeric"), ("previous_paid_date", 119, 126, "date"),
    ),
    "file_number",
)
