"""Joins with a policy: on either key, strictly one to one, three ways, over hashes, against sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def either_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) of rows that agree on one of the pairs of columns, each once: a union of equi-joins, no nested loop."""
    out = None
    for a, b in pairs:
        met = left.join(right, left[a] == right[b]).select(left[left_id], right[right_id])
        out = met if out is None else out.unionByName(met)
    return out.distinct()


def strict(parts: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(joined, report): rows joined one to one over all parts, and the count of duplicates, missing and total keys of each part.

    The report is one row per part; a caller that must not go on raises if a count is not zero.
    """
    counted = None
    for name, df in parts.items():
        n = df.groupBy(key).agg(F.count("*").alias(f"n_{name}"))
        counted = n if counted is None else counted.join(n, key, "full")
    zero = lambda name: F.coalesce(F.col(f"n_{name}"), F.lit(0))
    rows = counted.select(F.inline(F.array(*[F.struct(F.lit(p).alias("part"), zero(p).alias("n")) for p in parts])))
    total = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    report = rows.groupBy("part").agg(total(F.col("n") > 1).alias("duplicates"), total(F.col("n") == 0).alias("missing"), F.count("*").alias("keys"))
    good = counted
    for p in parts:
        good = good.where(F.col(f"n_{p}") == 1)
    joined = good.select(key)
    for df in parts.values():
        joined = joined.join(df, key)
    return joined, report


def overlap(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """How many distinct keys every combination of parts holds: one full outer join per part, then one aggregation."""
    out = None
    for name, df in parts.items():
        d = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"in_{name}", F.lit(True))
        out = d if out is None else out.join(d, key, "full")
    flags = [F.coalesce(f"in_{p}", F.lit(False)).alias(f"in_{p}") for p in parts]
    return out.groupBy(*flags).agg(F.count("*").alias("n_keys"))


def matched_ids(candidates: DataFrame, rows: DataFrame, on: str, group: str, id_: str) -> DataFrame:
    """Candidates with the sorted distinct ids of the rows that share ``on``; none gives an empty list."""
    ids = rows.groupBy(on).agg(F.array_sort(F.collect_set(id_)).alias("ids"))
    kind = dict(ids.dtypes)["ids"]
    return candidates.join(ids, on, "left").select(group, F.coalesce("ids", F.array().cast(kind)).alias("ids"))


def without_expected(stored: DataFrame, parents: DataFrame, key: str, values: str, at: str = "ordinal", value: str = "value") -> DataFrame:
    """Stored child rows (key, ordinal from 0, value) that the parents' arrays do not hold at that place."""
    expected = parents.select(key, F.posexplode(values).alias(at, value))
    return stored.join(expected, [key, at, value], "left_anti")


def expand_scope(addresses: DataFrame, wanted: DataFrame, base: str, document: str) -> DataFrame:
    """All addresses of the documents that have one of the wanted bases: two semi joins."""
    documents = addresses.join(wanted, base, "left_semi").select(document).distinct()
    return addresses.join(documents, document, "left_semi")


def in_scope(column: Column, values: list | None) -> Column:
    """Membership in a short list; no list means no restriction, an empty one nothing."""
    return F.lit(True) if values is None else F.coalesce(column.isin(*values), F.lit(False)) if values else F.lit(False)
