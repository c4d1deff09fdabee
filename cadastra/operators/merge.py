"""Idempotent merges of staged rows into keyed tables, as joins that write new tables.

A stage row carries ``row_index``; of several rows with one key the last wins.  A row is inserted if its key is new and
updated only if its hash or a guarded column differs, nulls being equal to each other; so a second run changes nothing.
All joins are equi-joins on the keys, the stage side reduced to one row per key by a partial aggregation first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Spec:
    """``guards``: a difference in one of them updates a row; ``keep_first``: the known value stays; ``earliest``/``latest``: the extreme stays."""

    keys: tuple[str, ...]
    guards: tuple[str, ...]
    keep_first: tuple[str, ...] = ()
    earliest: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()
    order: str = "row_index"


@dataclass(frozen=True)
class Reference:
    """A staged key ``via`` that names a row of ``parent``; the parent's ``pick`` becomes ``column``.

    Keys look like ``system:rest``; one with a system meets only parents of that system, one without meets any.
    ``hydrate`` maps further parent columns to staged columns that they fill where those are blank.
    """

    via: str
    parent: DataFrame
    pick: str
    column: str
    hydrate: dict[str, str] = field(default_factory=dict)
    parent_key: str = "source_record_key"
    parent_system: str | None = "source_system"


def last_wins(stage: DataFrame, spec: Spec) -> DataFrame:
    """One row per key, that of the highest order value; rows without a key column are left out."""
    rest = [c for c in stage.columns if c not in spec.keys]
    known = stage.dropna(subset=list(spec.keys))
    return known.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), spec.order).alias("_s")).select(*spec.keys, *[F.col(f"_s.`{c}`").alias(c) for c in rest if c != spec.order])


def system_of(key: Column) -> Column:
    return F.when(F.contains(key, F.lit(":")), F.split_part(key, F.lit(":"), F.lit(1)))


def resolve(stage: DataFrame, *references: Reference) -> DataFrame:
    """``stage`` with every reference resolved by a left join; the first of several references to one column that resolves wins."""
    out, made = stage, {}
    for k, r in enumerate(references):
        wanted = [r.parent_key, r.pick, *r.hydrate, *([r.parent_system] if r.parent_system else [])]
        parent = r.parent.select(*[F.col(c).alias(f"_p{k}_{c}") for c in dict.fromkeys(wanted)])
        on = F.col(r.via) == F.col(f"_p{k}_{r.parent_key}")
        if r.parent_system:
            system = system_of(F.col(r.via))
            on = on & (system.isNull() | (F.col(f"_p{k}_{r.parent_system}") == system))
        out = out.join(parent, on, "left")
        made.setdefault(r.column, []).append(F.col(f"_p{k}_{r.pick}"))
        for source, target in r.hydrate.items():
            out = out.withColumn(target, F.coalesce(F.nullif(F.col(target), F.lit("")), F.col(f"_p{k}_{source}")))
    return out.withColumns({c: F.coalesce(*xs) for c, xs in made.items()}).drop(*[c for c in out.columns if c.startswith("_p")])


def merge(target: DataFrame, stage: DataFrame, spec: Spec) -> DataFrame:
    """The merged table with ``change``: inserted, updated, unchanged or absent (not staged)."""
    columns = [c for c in target.columns if c not in spec.keys]
    t = target.select(*spec.keys, F.struct(*columns).alias("_t"))
    s = last_wins(stage, spec).select(*spec.keys, F.struct(*columns).alias("_s"))
    both = t.join(s, list(spec.keys), "full")
    differs = F.lit(False)
    for c in spec.guards:
        differs = differs | ~F.col(f"_t.{c}").eqNullSafe(F.col(f"_s.{c}"))
    change = F.when(F.col("_t").isNull(), "inserted").when(F.col("_s").isNull(), "absent").when(differs, "updated").otherwise("unchanged")

    def value(c: str) -> Column:
        old, new = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        chosen = F.coalesce(old, new) if c in spec.keep_first else F.least(old, new) if c in spec.earliest else F.greatest(old, new) if c in spec.latest else new
        return F.when(F.col("change").isin("inserted", "updated"), chosen).otherwise(old).alias(c)

    return both.withColumn("change", change).select(*spec.keys, *[value(c) for c in columns], "change")


def counters(stage: DataFrame, merged: DataFrame, spec: Spec) -> DataFrame:
    """attempted, deduped, changed and unchanged rows of one merge."""
    count = lambda kinds: F.coalesce(F.sum(F.col("change").isin(*kinds).cast("bigint")), F.lit(0))
    done = merged.agg(count(("inserted", "updated", "unchanged")).alias("deduped"), count(("inserted", "updated")).alias("changed"), count(("unchanged",)).alias("unchanged"))
    return stage.agg(F.count("*").alias("attempted")).join(done)


def write_merged(target_folder: str, merged: DataFrame) -> DataFrame:
    """Write the merged table to a new folder and read it again; the folder read from is never overwritten."""
    merged.drop("change").write.parquet(target_folder)
    return merged.sparkSession.read.parquet(target_folder)


def refresh_scope(target: DataFrame, stage: DataFrame, scope: str, spec: Spec) -> DataFrame:
    """``merge`` for a source that is staged whole: rows of the staged scopes that are not staged again are left out."""
    merged = merge(target, stage, spec)
    scopes = stage.select(scope).distinct()
    stale = merged.where("change = 'absent'").join(scopes, scope, "left_semi").select(*spec.keys)
    return merged.join(stale, list(spec.keys), "left_anti")


def delete_source(table: DataFrame, column: str, *sources: str) -> DataFrame:
    """The table without rows of the sources; rows without a source stay."""
    return table.where(~F.coalesce(F.col(column).isin(*sources), F.lit(False)))


def release(target: DataFrame, stage: DataFrame, key: str, name: str) -> DataFrame:
    """Rows (key, hash, first_seen, last_seen, is_current) after a release: absent keys are deactivated, returning ones keep first_seen."""
    s = stage.select(key, F.col("hash").alias("_hash")).dropDuplicates([key])
    there = F.col("_hash").isNotNull()
    both = target.join(s, key, "full")
    return both.select(
        key,
        F.when(there, F.col("_hash")).otherwise(F.col("hash")).alias("hash"),
        F.coalesce("first_seen", F.lit(name)).alias("first_seen"),
        F.when(there, F.lit(name)).otherwise(F.col("last_seen")).alias("last_seen"),
        there.alias("is_current"),
    )
