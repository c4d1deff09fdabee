"""Checks as rows (rule, expected, actual, ok): a gate raises if a row is not ok."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, rule: str, expected: Column, actual: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), expected.cast("bigint").alias("expected"), actual.cast("bigint").alias("actual")).withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique(df: DataFrame, rule: str, key: str) -> DataFrame:
    """Rows equal distinct keys plus rows without a key, and no row is without."""
    counted = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("d"), F.count_if(F.col(key).isNull()).alias("z"))
    return _row(counted, f"{rule}: rows", F.col("d") + F.col("z"), F.col("n")).unionByName(_row(counted, f"{rule}: without key", F.lit(0), F.col("z")))


def same_count(source: DataFrame, made: DataFrame, rule: str, key: str | None = None) -> DataFrame:
    """Distinct keys (or rows) of both."""
    n = lambda df: df.agg((F.countDistinct(key) if key else F.count("*")).alias("n"))
    return _row(n(source).select(F.col("n").alias("a")).join(n(made).select(F.col("n").alias("b"))), rule, F.col("a"), F.col("b"))


def orphans(child: DataFrame, parent: DataFrame, rule: str, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set and names no parent."""
    lost = child.where(F.col(child_key).isNotNull()).join(parent, child[child_key] == parent[parent_key], "left_anti")
    return _row(lost.agg(F.count("*").alias("n")), rule, F.lit(0), F.col("n"))


def none(df: DataFrame, rule: str, bad: Column) -> DataFrame:
    return _row(df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("n")), rule, F.lit(0), F.col("n"))


def at_least(df: DataFrame, rule: str, least: int, wanted: Column) -> DataFrame:
    """At least so many rows that hold; expected is capped at what is there."""
    counted = df.agg(F.count_if(F.coalesce(wanted, F.lit(False))).alias("n"))
    return counted.select(F.lit(rule).alias("rule"), F.lit(least).cast("bigint").alias("expected"), F.col("n").alias("actual"), (F.col("n") >= least).alias("ok"))


def duplicates(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    return _row(df.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.count_if(F.col("c") > 1).alias("n")), rule, F.lit(0), F.col("n"))


def equal_tables(a: DataFrame, b: DataFrame, rule: str) -> DataFrame:
    """Rows of one that the other lacks, repeats counted, both ways."""
    lost = a.exceptAll(b).unionAll(b.exceptAll(a))
    return _row(lost.agg(F.count("*").alias("n")), rule, F.lit(0), F.col("n"))


def unchanged(before: DataFrame, after: DataFrame, rule: str, table: str = "table", n: str = "n") -> DataFrame:
    """Counts per table that differ before and after; a table that comes or goes differs."""
    both = before.select(table, F.col(n).alias("_a")).join(after.select(table, F.col(n).alias("_b")), table, "full")
    return _row(both.agg(F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("n")), rule, F.lit(0), F.col("n"))


def require(checks: DataFrame) -> None:
    """Raises with the rules that do not hold; a report has a row per rule, so few rows are gathered."""
    bad = [f"{r.rule}: expected {r.expected}, found {r.actual}" for r in checks.where("not ok").collect()]
    if bad:
        raise ValueError("; ".join(bad))
