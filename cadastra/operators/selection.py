"""Picks, groups, samples and orders over keyed rows."""

from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF


def xorshift_indices(n: int, count: int, seed: int = 0x524F434B) -> list[int]:
    """``count`` distinct places among ``n``, in the order drawn by a 32-bit xorshift generator."""
    if n < count:
        raise ValueError(f"{n} rows are fewer than the sample of {count}")
    state, out = seed, {}
    while len(out) < count:
        state ^= state << 13 & MASK
        state ^= state >> 17
        state ^= state << 5 & MASK
        out[state % n] = None
    return list(out)


def sample(ranked: DataFrame, count: int, rank: str = "rank") -> DataFrame:
    """The drawn rows of a table with ranks from 0, with ``draw``, their order."""
    drawn = xorshift_indices(ranked.count(), count)
    places = ranked.sparkSession.createDataFrame(list(enumerate(drawn)), f"draw int, {rank} bigint")
    return ranked.join(F.broadcast(places), rank)


def first_occurrence(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each identity; partial results are merged before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def best(df: DataFrame, key: str, order: list[Column], *columns: str) -> DataFrame:
    """The row of each key that comes first by ``order`` (numbers negated for greatest first)."""
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_r")).select(key, "_r.*")


def first_samples(df: DataFrame, key: str, order: list[str], column: str, n: int) -> DataFrame:
    """(key, samples): the first ``n`` values of each key by ``order``; a group is cut to ``n`` rows before it is gathered."""
    w = Window.partitionBy(key).orderBy(*order)
    few = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    return few.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", column))), lambda x: x[column]).alias("samples"))


def collisions(pairs: dict[str, tuple[str, str]], df: DataFrame) -> DataFrame:
    """(measure, n): for each (group, value) pair the groups with more than one distinct value; nulls are no value."""
    wanted = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(g).cast("string").alias("g"), F.col(v).cast("string").alias("v")) for m, (g, v) in pairs.items()])
    each = df.select(F.inline(wanted)).where("g is not null and v is not null").groupBy("measure", "g").agg(F.countDistinct("v").alias("d"))
    return each.groupBy("measure").agg(F.count_if(F.col("d") > 1).alias("n"))


def class_counts(df: DataFrame, value: str, classes: dict[str, str]) -> DataFrame:
    """(class, n) of the texts that match each pattern, every class listed, in one pass."""
    counted = df.agg(*[F.count_if(F.coalesce(F.col(value).rlike(p), F.lit(False))).alias(c) for c, p in classes.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.col(c).alias("n")) for c in classes])))


def table_order(references: dict[str, list[str]]) -> list[str]:
    """Tables so that each comes behind those it refers to, otherwise by name; a cycle raises."""
    todo, out = TopologicalSorter({t: [r for r in rs if r != t] for t, rs in references.items()}), []
    todo.prepare()
    while todo.is_active():
        ready = sorted(todo.get_ready())
        out += ready
        todo.done(*ready)
    return out


def track_union(tracks: dict[str, list[str]], wanted: list[str]) -> list[str]:
    """The tables of the wanted tracks in their order, each once."""
    return list(dict.fromkeys(t for w in wanted for t in tracks[w]))
