"""Quality rules: a threshold table compiled into one projection, without user functions.

Word lengths are judged only in texts with as many Latin letters as others or more, and stop words only in
those of them whose ``lang`` is English, German, French or Spanish, null, or not given; a text of another
Latin language is told from one without function words by ``lang`` alone.  All other thresholds hold for every text.

Defined cases: a null or empty text has no words, so it fails the base rule and is rejected;
repeated rows are judged each; an empty table gives an empty result; extra columns pass through,
whatever their names, and columns that have a result's name in any case are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, passed
from .text import BLANKS, let, total, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of the languages served.
STOP_WORDS = tuple(
    "the of and to in is it that for on with as was are be by this at from or an "
    "der die das und ist nicht ein eine zu den mit von für auf im dem des sich "
    "le la les de des et en un une du que qui dans pour par sur est au "
    "el los las del que y en un una por con para se su al es".split()
)


#: Codes of these languages, with or without a region.
LISTED = r"^(?i:en|eng|de|deu|ger|fr|fra|fre|es|spa)(?:[-_].*)?$"


@dataclass(frozen=True)
class Threshold:
    """Rejects a text whose ``metric`` leaves [low, high], once it has ``from_words`` words, where ``only`` holds."""

    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 1
    only: str | None = None


THRESHOLDS = (
    Threshold("mean_word_chars", 2.0, 20.0, only="latin"),
    Threshold("symbols_per_word", high=0.3),
    Threshold("shouts_per_word", high=0.5),
    Threshold("dup_line_ratio", high=0.5),
    Threshold("stop_word_ratio", low=0.01, from_words=60, only="listed"),
)


def _repeat_words(ws: Column) -> Column:
    """Words inside a window of five that occurs at two or more places of the text.

    Windows of one text are told apart by 64-bit hashes; two of a million differing ones meet with odds below 1e-7.
    """
    n = F.size(ws)

    def covered(starts: Column) -> Column:
        return total(F.transform(starts, lambda p, k: F.when(k + 1 < F.size(starts), F.least(F.lit(WINDOW), F.get(starts, k + 1) - p)).otherwise(WINDOW).cast("bigint")))

    def repeated(hashed: Column) -> Column:
        tagged = F.sort_array(F.transform(hashed, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        twice = lambda s: F.filter(
            F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["k"])), lambda k: k.isNotNull()
        )
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0).cast("bigint")).otherwise(let(F.sort_array(let(tagged, twice)), covered))

    window = lambda k: F.xxhash64(*[F.get(ws, k + d) for d in range(WINDOW)])
    return F.when(n <= WINDOW, F.lit(0).cast("bigint")).otherwise(let(F.transform(F.sequence(F.lit(0), n - WINDOW), window), repeated))


def _latin(text: Column) -> Column:
    """Whether letters of other scripts are not more than Latin ones."""
    letters = lambda t, other: F.length(F.regexp_replace(t, other, ""))
    beyond = F.regexp_replace(text, r"[\x00-\x{24F}]++", "")
    return let(letters(beyond, r"(?:[^\p{L}\p{M}]|\p{IsLatin})++"), lambda n: F.when(n == 0, True).otherwise(n <= letters(text, r"\P{IsLatin}++")))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the metrics and conditions that thresholds may name."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c: c.cast("bigint")
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    cut, rows, shouts, stops = fresh(docs, "_words", "_lines", "_shouts", "_stops")
    ratios = ("mean_word_chars", "symbols_per_word", "shouts_per_word", "dup_line_ratio", "stop_word_ratio", "listed")
    listed = F.coalesce(F.col(lang).rlike(LISTED), F.lit(True)) if lang in docs.columns else F.lit(True)
    first = docs.withColumns({cut: words(t), rows: lines})
    w = F.col(cut)
    bare = lambda x: F.translate(F.lower(x), ".,;:!?#*$%&|<>\"'()", "")
    made = (
        {
            "n_words": long(F.size(w)),
            "word_chars": long(F.length(F.regexp_replace(t, BLANKS, ""))),
            "n_symbols": long(F.length(F.regexp_replace(t, f"[^{SYMBOLS}]++", ""))),
            "n_lines": long(F.size(rows)),
            "n_dup_lines": long(F.size(rows) - F.size(F.array_distinct(rows))),
            "n_repeat_words": _repeat_words(w),
            shouts: long(F.length(F.regexp_replace(t, "[^!]++", ""))),
            "latin": _latin(t),
            "listed": listed,
            stops: long(F.size(F.filter(w, lambda x: bare(x).isin(*dict.fromkeys(STOP_WORDS))))),
        }
    )
    # Generated columns keep a filter on them from being pushed down and computed anew.
    old = passed(docs, *made, *ratios)
    counted = first.select(*old, F.inline(F.array(F.struct(*[v.alias(k) for k, v in made.items()]))))
    c = F.col
    return counted.withColumns(
        {
            "mean_word_chars": ratio(c("word_chars"), c("n_words")),
            "symbols_per_word": ratio(c("n_symbols"), c("n_words")),
            "shouts_per_word": ratio(c(shouts), c("n_words")),
            "dup_line_ratio": ratio(c("n_dup_lines"), c("n_lines")),
            "stop_word_ratio": ratio(c(stops), c("n_words")),
            "listed": c("latin") & c("listed"),
        }
    ).drop(shouts, stops)


def verdict(table: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """The thresholds as one boolean column over measured metrics."""
    ok = F.lit(True)
    for r in table:
        inside = F.lit(True)
        if r.low is not None:
            inside = inside & (F.col(r.metric) >= r.low)
        if r.high is not None:
            inside = inside & (F.col(r.metric) <= r.high)
        if r.only is not None:
            inside = inside | ~F.col(r.only)
        ok = ok & ((F.col("n_words") < r.from_words) | inside)
    return ok


def apply_rules(docs: DataFrame, text: str = "text", table: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``docs`` with metrics, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    bare = docs.select(*passed(docs, "base_failed", "kept"))
    return measure(bare, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(table))
