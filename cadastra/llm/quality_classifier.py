"""Compression classifier: dictionaries of good and bad text, calibrated size difference.

Short pieces of a text are compressed with a zstandard dictionary made from good and one made from bad labelled
texts.  The difference of the sizes over their sum becomes a probability by a logistic curve fitted on labelled texts kept out
of the dictionaries.  At most ``SAMPLE`` distinct labelled texts of each class (smallest hashes), of
``SAMPLE_BYTES`` together but for the last one, and ``DICTIONARY`` bytes per dictionary are used; both classes are counted over all labelled rows and the curve
is weighted by these counts, so the class balance does not depend on the sample.  A dictionary is made of
pieces of ``PIECE`` bytes spread evenly over its texts from their first to their last byte.  Only the score's
fit is bounded, every text is scored whole.  Defined cases: null and empty texts score as the curve does at
zero difference and are not trained on; a text with both labels is sampled for each; with a class absent
all scores are the share of the other class, with an empty table one half; equal texts get equal scores; repeated
labelled rows count each, their text is sampled once; a column of scores is made, so other columns are the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, SAMPLE_BYTES, DICTIONARY, PIECE, LEVEL = 2000, 32 << 20, 1 << 17, 512, 3
#: Piece lengths in bytes to choose from; in short pieces the dictionary outweighs a text's own repeats.
CHUNKS = (48, 96, 192)


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float
    chunk: int = CHUNKS[0]


class Sizes:
    def __init__(self, model: Model):
        made = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (model.good, model.bad)]
        for d in made:
            d.precompute_compress(level=LEVEL)
        self.chunk = model.chunk
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False) for d in made]

    def difference(self, text: str | None) -> float:
        raw = (text or "").encode()
        pieces = [raw[k : k + self.chunk] for k in range(0, len(raw), self.chunk)]
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.by)
        return (bad - good) / (bad + good) if raw else 0.0


def _spread(texts: list[str]) -> bytes:
    """Pieces of PIECE bytes at even steps over all texts, DICTIONARY bytes at most."""
    raw = [t.encode() for t in texts]
    pieces = [r[k : k + PIECE] for r in raw for k in range(0, len(r), PIECE)]
    room = (sum(map(len, pieces)) + len(pieces)) / DICTIONARY
    if room > 1:
        pieces = [pieces[int(k * room)] for k in range(int(len(pieces) / room))]
    return b"\n".join(pieces)[:DICTIONARY]


def fit(rows: list[tuple[str, int]], counts: dict[int, int] | None = None) -> Model:
    """A model from (text, label) rows: every second row feeds a dictionary, the others the curve.

    ``counts`` are the labelled rows of each class that ``rows`` stand for; ``rows`` themselves if not given.
    """
    groups = {k: [t for t, y in rows if y == k and t] for k in (0, 1)}
    counts = counts or {k: len(g) for k, g in groups.items()}
    if not groups[0] or not groups[1]:
        share = (counts[1] + 0.5) / (counts[0] + counts[1] + 1)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    feed = {k: _spread(g[::2] if len(g) > 1 else g) for k, g in groups.items()}
    return min((_calibrated(groups, counts, feed, chunk) for chunk in CHUNKS), key=lambda x: x[0])[1]


def _calibrated(groups: dict[int, list[str]], counts: dict[int, int], feed: dict[int, bytes], chunk: int) -> tuple[float, Model]:
    """Log loss on the texts kept out of the dictionaries, weighted by class, and the model."""
    sizes = Sizes(Model(feed[1], feed[0], 0, 0, chunk))
    out = {k: g[1::2] or g for k, g in groups.items()}
    rest = [(sizes.difference(t), k, counts[k] / len(g)) for k, g in out.items() for t in g]
    x, y, w = np.array([r[0] for r in rest]), np.array([r[1] for r in rest], float), np.array([r[2] for r in rest])
    w *= len(w) / w.sum()
    x1, beta = np.c_[x, np.ones_like(x)], np.zeros(2)
    chance = lambda: 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
    for _ in range(60):
        p = chance()
        beta += np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + 1e-3 * np.eye(2), x1.T @ (w * (y - p)) - 1e-3 * beta)
    p = np.clip(chance(), 1e-9, 1 - 1e-9)
    return float(-np.average(y * np.log(p) + (1 - y) * np.log(1 - p), weights=w)), Model(feed[1], feed[0], float(beta[0]), float(beta[1]), chunk)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the SAMPLE distinct texts of smallest hashes of each class; only hashes of texts are joined and dealt."""
    t = F.col(text)
    hashed = docs.where(F.length(t) > 0).select(key, F.xxhash64(t).alias("h"), F.xxhash64(F.lit(1), t).alias("g"), F.octet_length(t).cast("bigint").alias("size"))
    marks = hashed.join(labels.where(F.col(label).isin(0, 1)).select(key, label), key).groupBy(label, "h", "g").agg(F.count("*").alias("n"), F.min(key).alias(key), F.max("size").alias("size")).persist()
    counts = {0: 0, 1: 0} | {r[0]: r[1] for r in marks.groupBy(label).agg(F.sum("n")).collect()}
    picked = [marks.where(F.col(label) == k).orderBy("h", "g").limit(SAMPLE) for k in (0, 1)]
    before = F.sum("size").over(Window.partitionBy(label).orderBy("h", "g")) - F.col("size")
    few = picked[0].unionByName(picked[1]).withColumn("_before", before).where(F.col("_before") < SAMPLE_BYTES)
    chosen = few.select(F.col(label).cast("int").alias("_y"), "h", "g", key)
    found = docs.select(key, text).join(F.broadcast(chosen), key).where((F.xxhash64(t) == F.col("h")) & (F.xxhash64(F.lit(1), t) == F.col("g")))
    rows = {(r._y, r.h, r.g): r[text] for r in found.select("_y", "h", "g", text).repartition(16).toLocalIterator()}
    marks.unpersist()
    return fit([(rows[k], k[0]) for k in sorted(rows)], counts)


def score(text: Column, docs: DataFrame, model: Model) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        sizes = Sizes(m) if m.good else None
        for batch in batches:
            d = np.array([sizes.difference(t.as_py()) if sizes else 0.0 for t in batch])
            yield pa.array(1 / (1 + np.exp(-np.clip(m.slope * d + m.shift, -30, 30))), pa.float64())

    return scored(text)
