"""Pick-one and merge operators over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def merge_counters(target: DataFrame, stage: DataFrame, key: str, row_hash: str) -> DataFrame:
    """How many staged rows a merge would insert, update and leave."""
    t = target.select(key, F.col(row_hash).alias("_old"), F.lit(True).alias("_there"))
    met = stage.select(key, row_hash).join(t, key, "left")
    there = F.col("_there").isNotNull()
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    same = F.col(row_hash).eqNullSafe(F.col("_old"))
    return met.agg(count(~there).alias("inserted"), count(there & ~same).alias("updated"), count(there & same).alias("unchanged"))
