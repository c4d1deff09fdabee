"""Near-duplicate components by bottom-k sketches, inverted lists and exact Jaccard.

One 64-bit hash stands for each distinct five-word shingle; the sketch of a text is its ``K``
smallest hashes.  Equal sets form a class first, so exact copies never meet each other.  Then:

1. Retained values are inverted into lists.  Linked texts share at least three eighths of their
   sketch but for odds below 1e-5, so by the prefix filter only the rarest ``n - 3n/8 + 1`` values of
   a sketch need be listed, and values of one class only are dropped.  A list pairs its members with
   its smallest class only, so pairs grow with the rows of the lists.  Pairs pass a length bound and
   the union-sketch estimate before exact Jaccard on full sets; links make components.
2. Classes in lists that still hold several components are open, and two classes of different
   components that share a listed value are both open.  A list pairs its members of other components with
   its hub, the class with the smallest share of shingles that no other open class has: in a group of edited
   copies that is the text closest to all others, whatever the order of the rows.
3. The full sets of open classes are ordered by rarity and listed anew, by value and size range of either
   side.  A set of ``n`` whose first common value with another stands at position ``i`` links only with sets
   of at most ``(4n - 7i) / 3``, so the values of a passage that many texts share no longer bring them
   together.  This step is an exact prefix and positional filter: members of different components that pass
   the positional bound are paired and verified.

Defined cases: null, empty and blank texts have no shingles and stay alone; fewer than five words
are one shingle; repeated rows are copies; extra columns pass through, result names are replaced; an empty
table gives an empty result; long texts are hashed whole.
Every row is compared by its own text: rows without an id or with an id that others have too are judged
each, and the id of a component is the smallest of its rows, null if none has one.  ``is_first`` marks one
row of each component: of those with the smallest id, or of all if none has one, the first as read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches

K, WIDTH, NUMERATOR, DENOMINATOR = 32, 5, 75, 100
#: The estimate has a deviation below 0.077 at the threshold; this floor lies five of them below 0.75.
FLOOR = 0.365
#: Ratio of the size ranges by which open lists are split.
RANGE = 1.1
_BASE, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(33)


def hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``text``."""
    # bytes are split on space and tab to carriage return, and folded in A-Z, exactly as words are defined here
    ws = text.encode().lower().split() if text else []
    if not ws:
        return np.empty(0, np.int64)
    words = np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))
    width = min(WIDTH, len(ws))
    made = np.full(len(ws) - width + 1, width, np.uint64)
    for k in range(width):
        made = made * _BASE + words[k : len(ws) - width + 1 + k]
    made = (made ^ (made >> _HALF)) * _MIX1
    made = (made ^ (made >> _HALF)) * _MIX2
    return np.unique((made ^ (made >> _HALF)).view(np.int64))


def features_of(text: Column) -> Column:
    """Set size, digest of the set and sketch."""

    @F.arrow_udf("struct<n:bigint,set_id:binary,sketch:array<bigint>>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("n", pa.int64()), ("set_id", pa.binary()), ("sketch", pa.list_(pa.int64()))])
        for batch in batches:
            sets = (hashes(t.as_py()) for t in batch)
            yield pa.array([{"n": len(h), "set_id": xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None, "sketch": h[:K].copy()} for h in sets], kind)

    return made(text)


def set_of(text: Column) -> Column:
    @F.arrow_udf("array<bigint>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([hashes(t.as_py()) for t in batch], pa.list_(pa.int64()))

    return made(text)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def inverted(classes: DataFrame) -> DataFrame:
    """(value, id) rows of the rarest values that a linked pair cannot all miss."""
    rows = classes.select("id", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    seen = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(seen, "value").groupBy("id", "s").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    alone = F.col("s") - F.size("v")
    take = F.col("s") - F.floor(F.col("s") * 3 / 8).cast("int") + 1 - alone
    return shared.where(take > 0).select("id", F.explode(F.slice("v", 1, take.cast("int"))).alias("v")).select("id", "v.value")


def verify(pairs: DataFrame, sets: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (a, b) whose exact Jaccard reaches the threshold; full sets are fetched for those that the sketches let pass."""
    brief = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))
    union = F.slice(F.sort_array(F.array_union("ka", "kb")), 1, K)
    estimate = F.size(F.array_intersect(F.array_intersect("ka", "kb"), union)) / F.size(union)
    alike = F.least("na", "nb") * DENOMINATOR >= F.greatest("na", "nb") * NUMERATOR
    near = cut(pairs.join(brief("a"), "a").join(brief("b"), "b").where(alike & (estimate >= FLOOR)).select("a", "b", "na", "nb"))
    whole = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}"))
    common = F.size(F.array_intersect("sa", "sb"))
    exact = common * DENOMINATOR >= (F.col("na") + F.col("nb") - common) * NUMERATOR
    return cut(near.join(whole("a"), "a").join(whole("b"), "b").where(exact).select("a", "b"))


def components(nodes: DataFrame, edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, comp) with the smallest id reachable, by minimum labels and pointer jumping."""
    ways = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    first = ways.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
    labels = cut(nodes.join(first, "id", "left").select("id", F.least("id", "near").alias("comp")))
    while True:
        offered = ways.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        better = labels.join(offered, "id", "left").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = cut(better.join(jump, "comp", "left").select("id", "old", F.least("comp", "far").alias("comp")))
        moved = not new.where("comp < old").isEmpty()
        labels = new.select("id", "comp")
        if not moved:
            return labels


def merged(labels: DataFrame, edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``labels`` after further ``edges``: only the components that these join are worked on."""
    end = lambda x: labels.select(F.col("id").alias(x), F.col("comp").alias(f"c{x}"))
    joined = edges.join(end("a"), "a").join(end("b"), "b").where("ca != cb")
    between = cut(joined.select(*_pair("ca", "cb")).distinct())
    if between.isEmpty():
        return labels
    tops = components(between.select(F.explode(F.array("a", "b")).alias("id")).distinct(), between, cut)
    return cut(labels.join(tops.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp", "left").select("id", F.coalesce("top", "comp").alias("comp")))


def ranked(sets: DataFrame) -> DataFrame:
    """(id, n, common, prefix): how many values of a full set other sets have too, and those of them that stand in its prefix, rarest first."""
    rows = sets.select("id", F.explode("shingles").alias("value"))
    seen = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(seen, "value").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v")).join(sets.select("id", "n"), "id")
    take = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1 - (F.col("n") - F.size("v"))
    return shared.select("id", "n", F.size("v").alias("common"), F.transform(F.slice("v", F.lit(1), F.greatest(take, F.lit(0)).cast("int")), lambda x: x["value"]).alias("prefix"))


def positional(ranks: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (list, low, id, n, at) of the prefix values of full sets, listed by value and the size ranges of both sides.

    ``low`` rows stand on the side of the smaller range.  Values that one component only has in prefixes are left out.
    """
    rows = ranks.select("id", "n", (F.col("n") - F.col("common")).alias("alone"), F.posexplode("prefix").alias("at", "value"))
    mixed = rows.join(labels, "id").groupBy("value").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most")
    found = rows.join(mixed, "value", "left_semi").select("id", "n", (F.col("at") + F.col("alone")).alias("at"), "value")
    size = lambda x: F.floor(F.log(x) / math.log(RANGE))
    most = F.floor((F.lit(4) * F.col("n") - F.lit(7) * F.col("at")) / 3)
    ranged = found.select("id", "n", "at", "value", size(F.col("n")).alias("own"), size(F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)).alias("lo"), size(F.greatest(most, F.lit(1))).alias("hi"))
    low = ranged.where("hi >= own").select("id", "n", "at", "value", F.col("own").alias("x"), F.explode(F.sequence("own", "hi")).alias("y"), F.lit(True).alias("low"))
    high = ranged.where("least(hi, own) >= lo").select("id", "n", "at", "value", F.explode(F.sequence("lo", F.least("hi", "own"))).alias("x"), F.col("own").alias("y"), F.lit(False).alias("low"))
    return low.unionByName(high).select(F.xxhash64("value", "x", "y").alias("list"), "low", "id", "n", "at")


def _mixed(lists: DataFrame, labels: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of the lists that hold several components, with their component and the largest one of the list."""
    placed = lists.join(labels.join(labels.groupBy("comp").agg(F.count("*").alias("m")), "comp"), "id")
    of_list = placed.groupBy("list").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.max(F.struct("m", "comp")).alias("main"))
    return cut(placed.drop("m").join(of_list.where("least < most").select("list", F.col("main.comp").alias("main")), "list"))


def _across(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of members of different components whose positions allow a link."""
    lo = left.select("list", *[F.col(c).alias(f"{c}1") for c in ("id", "n", "at", "comp")])
    hi = right.select("list", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "at", "comp")])
    reach = F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2")) * (DENOMINATOR + NUMERATOR)
    return lo.join(hi, "list").where((F.col("comp1") != F.col("comp2")) & (reach >= (F.col("n1") + F.col("n2")) * NUMERATOR)).select(*_pair("id1", "id2"))


def linked_components(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, comp) of the classes that share a listed value with others; ``sets_of`` gives (id, n, sketch, shingles) for ids."""
    lists = cut(inverted(classes))
    nodes = cut(lists.select("id").distinct())
    sets = cut(sets_of(nodes))
    leaders = lists.groupBy("value").agg(F.min("id").alias("leader"))
    star = lists.join(leaders, "value").where("id != leader").select(*_pair("id", "leader")).distinct()
    labels = components(nodes, verify(star, sets, cut), cut)
    placed = lists.join(labels, "id")
    mixed = placed.groupBy("value").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most")
    open_lists = cut(placed.join(mixed, "value", "left_semi"))
    if open_lists.isEmpty():
        return labels
    ranks = cut(ranked(sets.join(open_lists.select("id").distinct(), "id", "left_semi")))
    own = ranks.select("id", (F.col("common") / F.col("n")).alias("share"))
    # A class without any common value has no row of its own there.
    hubs = open_lists.join(own, "id", "left").groupBy("value").agg(F.min_by(F.struct("id", "comp"), F.struct(-F.coalesce("share", F.lit(0.0)), "id")).alias("hub"))
    apart = open_lists.join(hubs, "value").where("comp != hub.comp").select("id", F.col("hub.id").alias("hub"))
    labels = merged(labels, verify(cut(apart.select(*_pair("id", "hub")).distinct()), sets, cut), cut)
    rows = _mixed(cut(positional(ranks, labels)), labels, cut)
    low, high, main = rows.where("low"), rows.where("not low"), F.col("comp") == F.col("main")
    rest = _across(low.where(~main), high).unionByName(_across(low.where(main), high.where(~main)))
    return merged(labels, verify(cut(rest.distinct()), sets, cut), cut)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with n_shingles, component_id (smallest ``key`` reachable) and is_first."""
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    cut, kept = scratch.cut, lambda df: scratch.cut(df, "kept")
    passed = [c for c in docs.columns if c not in ("n_shingles", "component_id", "is_first")]
    held = {c: f"_c{k}" for k, c in enumerate(passed)}
    doc = F.col(held[key])
    features = kept(docs.select(*[F.col(c).alias(x) for c, x in held.items()], features_of(F.col(text)).alias("f")).select(*held.values(), "f.*", F.monotonically_increasing_id().alias("row")))
    classes = cut(features.where("n > 0").groupBy("set_id").agg(F.min("row").alias("id"), F.min(F.struct(doc.isNull().alias("none"), doc.alias("doc"), "row")).alias("least"), F.min(F.struct("n", "sketch")).alias("f")).select("set_id", "id", "least", "f.*"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        texts = features.select(F.col("row").alias("id"), F.col(held[text]).alias("_t"), "n", "sketch").join(nodes, "id", "left_semi")
        return texts.select("id", "n", "sketch", set_of(F.col("_t")).alias("shingles"))

    labels = linked_components(classes, sets_of, cut)
    placed = classes.join(labels, "id", "left").select("set_id", "least", F.coalesce("comp", "id").alias("comp"))
    of_set = kept(placed.select("set_id", "comp").join(placed.groupBy("comp").agg(F.min("least").alias("least")), "comp"))
    scratch.drop()
    judged = features.join(of_set, "set_id", "left")
    alone = F.col("least").isNull()
    made = [F.col("n").alias("n_shingles"), F.when(alone, doc).otherwise(F.col("least.doc")).alias("component_id"), (alone | (F.col("row") == F.col("least.row"))).alias("is_first")]
    return judged.select(*[F.col(x).alias(c) for c, x in held.items()], *made)
