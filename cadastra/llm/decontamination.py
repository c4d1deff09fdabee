"""Benchmark decontamination: prefix-filtered containment join of item windows and texts.

Every benchmark item gives windows of ``window`` consecutive words (the whole item if shorter).
Containment of a whole window needs every word of it, so by the prefix filter one word, the
rarest, is enough as key.  Rarity counts each vocabulary word over all documents.  A text's word
that is a key bounds the window's position exactly; the window's words are then verified there.

A benchmark of at most ``BROADCAST_BYTES`` of text is indexed once and broadcast, and texts probe the index in
one pass.  A larger one is never gathered: its windows, their keys and the documents' words are joined by
shuffles, one key row per word, so that words that many documents have are split by the skew join.

Defined cases: null and empty texts have no words and no hits; items without words give
no window; repeated items count by distinct item_id; items without an id count as one item, the empty string;
an empty benchmark leaves all clean; repeated rows are judged each; long texts are searched whole; extra
columns pass through, whatever their names, and columns that have a result's name in any case are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, fresh, passed
from .text import NOT_WORD, ascii_lower, words

#: Benchmark text up to this size is broadcast; the index takes about fifty times as much memory.
BROADCAST_BYTES = 4 << 20
#: Separators of words before lower-casing.
NOT_CASED_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
HITS = "struct<n_words:bigint,hit_at:array<int>,items:array<string>>"
#: Folds A-Z and turns every other ASCII character but digits and a-z into a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def _said(docs: DataFrame, text: str) -> DataFrame:
    """(word, count) of all documents."""
    # Words are cut first and lower-cased singly: all but a few are plain ASCII, which ``lower`` folds in bulk.
    cased = docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), NOT_CASED_WORD)).alias("w")).where("w != ''")
    plain = F.octet_length("w") == F.length("w")
    said = cased.groupBy("w").count().select(F.when(plain, F.lower("w")).otherwise(ascii_lower(F.col("w"))).alias("word"), "count")
    return said.groupBy("word").agg(F.sum("count").alias("count"))


def word_counts(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences over all documents of each word that some item has."""
    vocabulary = items.select(F.explode(words(ascii_lower(F.col("text")), NOT_WORD)).alias("word")).distinct()
    return _said(docs, text).join(vocabulary, "word", "left_semi")


class Index:
    """Windows with their items, and for each key word the places that it takes in windows."""

    def __init__(self, items: list[tuple[str, str | None]], seen: dict[str, int], window: int):
        found, counts = defaultdict(set), {w.encode(): n for w, n in seen.items()}
        for item, text in items:
            ws = tokens(text)
            n = min(window, len(ws))
            for k in range(len(ws) - n + 1 if ws else 0):
                found[b" ".join(ws[k : k + n])].add(item)
        keyed = defaultdict(set)
        for joined in found:
            ws = joined.split(b" ")
            at = min(range(len(ws)), key=lambda k: (counts.get(ws[k], 0), ws[k], k))
            keyed[ws[at]].add((at, len(ws)))
        self.windows, self.keyed = {w: tuple(ids) for w, ids in found.items()}, {w: tuple(x) for w, x in keyed.items()}

    def find(self, ws: list[bytes]) -> tuple[list[int], list[str]]:
        """Positions of hit words and ids of items with a window in ``ws``."""
        hit, items, keyed = set(), set(), self.keyed
        for p in [p for p, w in enumerate(ws) if w in keyed]:
            for at, n in keyed[ws[p]]:
                a = p - at
                if a >= 0 and a + n <= len(ws) and (ids := self.windows.get(b" ".join(ws[a : a + n]))):
                    hit.update(range(a, a + n))
                    items.update(ids)
        return sorted(hit), sorted(items)


def _scan(shared: Broadcast):
    @F.arrow_udf(HITS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_words", pa.int64()), ("hit_at", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        for batch in batches:
            rows = []
            for t in batch:
                ws = tokens(t.as_py())
                hit, ids = shared.value.find(ws)
                rows.append({"n_words": len(ws), "hit_at": hit, "items": ids})
            yield pa.array(rows, kind)

    return scan


def _windows(ws: Column, window: int) -> Column:
    """Joined windows of a list of words."""
    n = F.least(F.size(ws), F.lit(window))
    one = lambda k: F.array_join(F.slice(ws, k + 1, n), " ")
    return F.when(F.size(ws) > 0, F.transform(F.sequence(F.lit(0), F.size(ws) - n), one)).otherwise(F.array().cast("array<string>"))


def _joined(docs: DataFrame, benchmark: DataFrame, text: str, window: int) -> DataFrame:
    """``mark`` without any gathered index."""
    cut = Scratch(docs.sparkSession).cut
    kept = passed(docs, "n_words", "hit_at", "items")
    row, ws, target = fresh(docs, "_row", "_ws", "_target")
    docs = cut(docs.select("*", F.monotonically_increasing_id().alias(row)))
    split = docs.select(F.col(row).alias("row"), words(ascii_lower(F.col(text)), NOT_WORD).alias("ws"))
    item_words = benchmark.select("item_id", words(ascii_lower(F.col("text")), NOT_WORD).alias("ws"))
    windows = cut(item_words.select("item_id", F.explode(_windows(F.col("ws"), window)).alias("window")).distinct())
    parts = windows.select("window").distinct().select("window", F.posexplode(F.split("window", " ")).alias("at", "word"))
    rare = parts.join(_said(docs, text), "word", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "word", "at")).alias("k"))
    keys = cut(rare.select("k.word", "k.at", F.size(F.split("window", " ")).alias("n")).groupBy("word").agg(F.collect_set(F.struct("at", "n")).alias("places")))
    placed = split.select("row", F.size("ws").alias("m"), F.posexplode("ws").alias("pos", "word")).join(keys, "word").select("row", "m", "pos", F.inline("places"))
    bounded = placed.where((F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.col("n") <= F.col("m")))
    starts = bounded.groupBy("row").agg(F.collect_set(F.struct((F.col("pos") - F.col("at")).alias("start"), "n")).alias("starts"))
    tried = split.join(starts, "row").select("row", F.explode(F.transform("starts", lambda s: F.struct(s["start"], s["n"], F.array_join(F.slice("ws", s["start"] + 1, s["n"]), " ").alias("window")))).alias("s")).select("row", "s.*")
    hits = tried.join(windows, "window").groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias("found"), F.array_sort(F.collect_set("item_id")).alias("ids"))
    at = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))))
    hits = hits.select(F.col("row").alias(target), at.alias("hit_at"), F.col("ids").alias("items"))
    bare = docs.select(*kept, row, F.size(words(ascii_lower(F.col(text)), NOT_WORD)).cast("bigint").alias("n_words"))
    none = {"hit_at": F.coalesce("hit_at", F.array().cast("array<int>")), "items": F.coalesce("items", F.array().cast("array<string>"))}
    return bare.join(hits, F.col(row) == F.col(target), "left").drop(row, target).withColumns(none)


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` with n_words, hit_at (word positions) and items (ids with an occurring window)."""
    bounded_batches(docs.sparkSession)
    benchmark = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = benchmark.select(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16)).first()[0] or 0
    if size > BROADCAST_BYTES:
        return _joined(docs, benchmark, text, window)
    seen = {r.word: r["count"] for r in word_counts(docs, benchmark, text).toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in benchmark.toLocalIterator()], seen, window))
    (hits,) = fresh(docs, "_hits")
    found = docs.select(*passed(docs, "n_words", "hit_at", "items"), _scan(shared)(F.col(text)).alias(hits))
    return found.select(*passed(found, hits), f"{hits}.*")
