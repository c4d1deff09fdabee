"""Byte-level BPE: ranked merges folded over the bytes of distinct words.

A text is cut by the tokenizer's pattern; each distinct word is merged once per worker, while it is
remembered.  The
rank table (one row per token) is broadcast.  Merges of long words run over a heap, so one very long
word costs n log n.  Decoding concatenates the binary pieces.  Defined cases: null and empty texts have no
ids and decode to no bytes; an id that the table lacks raises an error; columns are made, so repeated rows are
encoded each, other columns are the caller's, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Distinct words that a worker remembers, and their most characters; others are merged anew.  The memory
#: thus stays below 2 ** 18 entries of about 1 kB at most.
MEMORY, REMEMBERED = 1 << 18, 64
#: Words up to this many bytes are folded over a plain list, longer ones over a heap.
SHORT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` of a short word: scanning its few pairs costs less than a heap."""
    get, none = ranks.get, 1 << 31
    parts = [word[k : k + 1] for k in range(len(word))]
    pairs = [get(word[k : k + 2], none) for k in range(len(word) - 1)]
    while pairs and (least := min(pairs)) < none:
        k = pairs.index(least)
        parts[k] += parts.pop(k + 1)
        del pairs[k]
        if k < len(pairs):
            pairs[k] = get(parts[k] + parts[k + 1], none)
        if k:
            pairs[k - 1] = get(parts[k - 1] + parts[k], none)
    return [ranks[x] for x in parts]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always the adjacent pair of lowest rank, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= SHORT:
        return _fold(word, ranks)
    end, after, before, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(a: int) -> None:
        b = after[a]
        if b < n and (r := ranks.get(word[a : end[b]])) is not None:
            heap.append((r, a, end[b])) if not ready else heapq.heappush(heap, (r, a, end[b]))

    ready = False
    for a in range(n):
        offer(a)
    heapq.heapify(heap)
    ready = True
    while heap:
        _, a, stop = heapq.heappop(heap)
        if not alive[a] or (b := after[a]) >= n or end[b] != stop:
            continue
        alive[b], end[a], after[a] = False, stop, after[b]
        if after[a] < n:
            before[after[a]] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a : end[a]]])
        a = after[a]
    return out


def tokenizer(spark: SparkSession, path: str, pattern: str) -> tuple[Broadcast, str]:
    return spark.sparkContext.broadcast(read_ranks(path)), pattern


def encode(text: Column, using: tuple[Broadcast, str]) -> Column:
    """Token ids of ``text``."""
    shared, pattern = using

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks, cut = shared.value, regex.compile(pattern)
        known = lru_cache(MEMORY)(lambda w: merge(w.encode(), ranks))
        for batch in batches:
            flat, ends = array("i"), [0]
            for x in batch:
                for w in cut.findall(x.as_py() or ""):
                    flat.extend(known(w) if len(w) <= REMEMBERED else merge(w.encode(), ranks))
                ends.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))

    return ids(text)


def _lists(batch: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a batch, as slices of its flat values; null lists are empty."""
    ends, values = batch.offsets.to_numpy(), batch.values.to_numpy()
    return (values[a:b] if ok else values[:0] for a, b, ok in zip(ends[:-1], ends[1:], batch.is_valid().to_pylist()))


def decode(ids: Column, using: tuple[Broadcast, str]) -> Column:
    """Bytes of a list of ids."""
    shared = using[0]

    @F.arrow_udf("binary")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        piece = {i: b for b, i in shared.value.items()}.__getitem__
        for batch in batches:
            yield pa.array([b"".join(map(piece, x.tolist())) for x in _lists(batch)], pa.binary())

    return pieces(ids)


def little_endian(ids: Column) -> Column:
    """Ids as unsigned 32-bit little-endian integers."""

    @F.arrow_udf("binary")
    def packed(batch: pa.Array) -> pa.Array:
        return pa.array([x.astype("<u4").tobytes() for x in _lists(batch)], pa.binary())

    return packed(ids)
