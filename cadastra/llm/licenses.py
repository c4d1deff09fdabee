"""License scan: ordered signature rules behind a keyword prefilter, as native expressions.

Rules are the hand-written signatures of ``license_signatures``: SPDX identifiers, grants, notices, addresses,
statements and names, in order of priority.  A text is matched only against the rules whose keywords are
all among its words.  Detections are ordered by start, longest first, then by priority; one whose interval lies inside an
earlier one is suppressed, so an equal interval goes to the rule of higher priority.

Defined cases: a null or empty text has no words and no labels; repeated rows are scanned each; an empty
table gives an empty result; extra columns pass through, whatever their names, and columns that have a
result's name in any case are replaced; long texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, passed
from .license_signatures import rules
from .text import NOT_WORD, ascii_lower, let, words

#: Phrases that always count, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

SCORE_BASE = 0.8


def _places(ws: Column, phrase: str) -> Column:
    parts = phrase.split()
    stands = lambda i: F.forall(F.array(*[F.get(ws, i + k) == w for k, w in enumerate(parts)]), lambda x: F.coalesce(x, F.lit(False)))
    at = F.filter(F.transform(ws, lambda w, i: F.when((w == parts[0]) & stands(i), i)), lambda i: i.isNotNull())
    return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(BASE[phrase]).alias("label")))


def _of(phrase: str):
    return lambda ws: _places(ws, phrase)


def _detections(text: Column, rule: Column) -> Column:
    """Spans of one rule from the pieces between its matches."""
    pieces, found = F.split(text, rule["pattern"]), F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,score:double>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        hit = F.struct(begin.alias("start"), (-end).alias("stop"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["score"].alias("score"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(hit)).alias("out"))

    zipped = F.filter(F.arrays_zip(pieces.alias("piece"), found.alias("match")), lambda x: x["match"].isNotNull())
    return F.aggregate(zipped, start, step, lambda a: a["out"])


def _resolve(found: Column) -> Column:
    """Labels and best confidence of detections that no earlier interval contains."""
    nothing = F.struct(F.lit(0).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("n"))

    def step(a: Column, x: Column) -> Column:
        inside = -x["stop"] <= a["reach"]
        grown = F.struct((-x["stop"]).alias("reach"), F.array_union(a["labels"], F.array(x["label"])).alias("labels"), F.greatest(a["score"], x["score"]).alias("score"), (a["n"] + 1).alias("n"))
        return F.when(inside, a).otherwise(grown)

    return F.aggregate(F.sort_array(found), nothing, step)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, places (word index, label), detected (labels, score, n)."""
    low = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    made = ("n_words", "places", "detected")
    folded, cut, said = fresh(docs, "_low", "_words", "_said")
    needs = {k: [alt.split("/") for alt in key.split()] for k, _, key, _, _ in rules()}
    vocabulary = sorted({w for alts in needs.values() for alt in alts for w in alt} | {w for p in BASE for w in p.split()})
    listed = lambda xs: F.array(*[F.lit(x) for x in xs])
    lit_rules = F.array(
        *[F.struct(F.lit(k).alias("priority"), F.lit(lb).alias("label"), F.array(*[listed(alt) for alt in needs[k]]).alias("needs"), F.lit(p).alias("pattern"), F.lit(s).alias("score")) for k, lb, _, p, s in rules()]
    )
    first = docs.select(*passed(docs, *made), low.alias(folded)).withColumn(cut, words(F.col(folded), NOT_WORD)).withColumn(said, F.array_intersect(cut, listed(vocabulary)))
    none = F.array().cast("array<struct<at:int,label:string>>")
    base = F.flatten(F.array(*[F.when(F.forall(listed(p.split()), lambda w: F.array_contains(said, w)), let(F.col(cut), _of(p))).otherwise(none) for p in BASE]))
    active = F.filter(lit_rules, lambda r: F.forall(r["needs"], lambda alt: F.arrays_overlap(alt, said)))
    nothing = F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,score:double>>")
    spans = let(active, lambda rs: F.when(F.size(rs) == 0, nothing).otherwise(F.flatten(F.transform(rs, lambda r: _detections(F.col(folded), r)))))
    return first.withColumns({"n_words": F.size(cut).cast("bigint"), "places": base, "detected": _resolve(spans)}).drop(folded, cut, said)
