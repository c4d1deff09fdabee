"""Secret scan: every rule in one deterministic automaton, one pass over the bytes.

The rules are compiled together by subset construction and minimised into one transition
array (``automaton.compile_rules``).  A text is encoded with one byte per code point, so byte
offsets are code-point offsets; characters that no rule can name share a byte.  The single pass
notices the end of a match; a mirrored automaton then walks back to the leftmost start and the
rule's own forward automaton finds the longest end.  Matches of one kind do not overlap.  The automaton of a rule
beside the base ones matches what the secret begins with; its span goes on through the body by a linear expression
applied behind the match only: a private key's from BEGIN to the END line, or without END to the end of the base64
lines.  Minimal lengths hold for the whole span.

Defined cases: a null or empty text has no spans; extra columns pass through untouched and a
column that already has the result's name in any case is replaced; repeated rows are scanned each; an empty table
gives an empty result; long texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import length_hint

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import automaton
from .common import bounded_batches, fresh


@dataclass(frozen=True)
class Rule:
    """``least`` counts characters of the match, or of what follows the separator in it (``value_only``); ``tail`` goes on behind the match."""

    kind: str
    pattern: str
    least: int = 0
    value_only: bool = False
    tail: str = ""


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+"""

#: Public credential formats, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", _ASSIGN, 6, value_only=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Characters between the lines of a key: armour headers, base64, and what quoting in code, JSON, YAML or mail adds.
_GAP = r"""(?:[\s"'+>|#*,;]|\\[nrt\\"'])"""
_KEY_BODY = rf"""(?:[A-Za-z0-9/=:.()_]|{_GAP}|\\|-(?!----))*+-----END\ [A-Z\ ]*PRIVATE\ KEY-----"""
#: Without END: headers, lines of 16 base64 characters and more, and a shorter last line that fills its line or is padded.
_KEY_REST = rf"""(?:{_GAP}*+(?:Proc-Type|DEK-Info|Comment):[^\n\\]*+)*+(?:{_GAP}*+(?:[A-Za-z0-9/]|\+(?!\s)){{16,}}+={{0,2}}+)++(?:{_GAP}++[A-Za-z0-9+/]++(?:={{1,2}}+|(?=["']|\\[nr]|[\x20\t]*+(?:[\r\n]|\Z))))?"""
#: Only the base hex rule counts characters: counters of several rules multiply the states, so lengths
#: are checked by ``least``.  Bodies that hold other rules' prefixes multiply them too, so the automaton of an
#: extra rule ends with its prefix and the body is its tail.
EXTRA_RULES = (
    Rule("github", r"gh[pousr]_", 40, tail=r"[A-Za-z0-9]+"),
    Rule("github_fine", r"github_pat_", 40, tail=r"[A-Za-z0-9_]+"),
    Rule("gitlab", r"glpat-", 26, tail=r"[A-Za-z0-9_\-]+"),
    Rule("slack", r"xox[abeoprs]-", 20, tail=r"[A-Za-z0-9\-]+"),
    Rule("slack_hook", r"hooks\.slack\.com/services/T", 50, tail=r"[A-Za-z0-9/]+"),
    Rule("stripe", r"[rs]k_(?:live|test)_", 24, tail=r"[A-Za-z0-9]+"),
    Rule("google_key", r"AIza", 39, tail=r"[A-Za-z0-9_\-]+"),
    Rule("google_oauth", r"ya29\.", 25, tail=r"[A-Za-z0-9_\-]+"),
    Rule("npm", r"npm_", 40, tail=r"[A-Za-z0-9]+"),
    Rule("pypi", r"pypi-AgEIcHlwaS5vcmc", 60, tail=r"[A-Za-z0-9_\-]+"),
    Rule("sendgrid", r"SG\.", 60, tail=r"[A-Za-z0-9_\-]{16,32}\.[A-Za-z0-9_\-]+"),
    Rule("shopify", r"shp(?:at|ca|pa|ss)_", 38, tail=r"[0-9a-fA-F]+"),
    Rule("digitalocean", r"do[opr]_v1_", 64, tail=r"[0-9a-f]+"),
    Rule("jwt", r"eyJ", 40, tail=r"[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, tail=f"{_KEY_BODY}|{_KEY_REST}"),
)
RULES = BASE_RULES + EXTRA_RULES

#: A value is the longest tail of these characters behind the separator of an assignment.
_VALUE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


def _value_length(match: bytes) -> int:
    """Length of group 2 of an assignment: what follows the first ``:`` or ``=``, blanks and quote."""
    cut = min(k for k in (match.find(b":"), match.find(b"=")) if k >= 0) + 1
    rest = match[cut:].lstrip(b" ")
    return len(rest) - (rest[:1] in (b'"', b"'"))


class Scanner:
    """All rules compiled; ``scan`` gives the spans of one text."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        nodes = [automaton.parse(r.pattern) for r in rules]
        self.all = automaton.compile_rules(nodes, search=True)
        own = lambda node: automaton.compile_rules([node], search=False, classes=self.all.classes)
        self.forward = [own(n) for n in nodes]
        self.backward = [own(automaton.mirrored(n)) for n in nodes]
        self.tails = [re.compile(r.tail.encode(), re.ASCII) if r.tail else None for r in rules]

    @staticmethod
    def _furthest(dfa: automaton.Dfa, steps) -> int:
        """Steps taken up to the last accepting state, or 0."""
        s, table, accepting, dead, best = dfa.start, dfa.table, dfa.accepting, dfa.dead, 0
        for k, c in enumerate(steps, 1):
            s = table[s + c]
            if s >= accepting:
                best = k
            elif s == dead:
                break
        return best

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule number, end) of every match, sorted."""
        if not text:
            return []
        raw = text.encode("latin-1", "replace")
        data = raw.translate(self.all.classes)
        table, accepting, width, says = self.all.table, self.all.accepting, self.all.width, self.all.rules
        done, found, n = [0] * len(self.rules), [], len(data)
        s, it = self.all.start, iter(data)
        for c in it:
            s = table[s + c]
            if s >= accepting:
                end = n - length_hint(it)
                for rule in says[s // width]:
                    if end <= (floor := done[rule]):
                        continue
                    back = self._furthest(self.backward[rule], (data[k] for k in range(end - 1, floor - 1, -1)))
                    if not back:
                        continue
                    start = end - back
                    stop = start + self._furthest(self.forward[rule], (data[k] for k in range(start, n)))
                    if self.tails[rule] and (more := self.tails[rule].match(raw, stop)):
                        stop = more.end()
                    done[rule] = stop
                    r = self.rules[rule]
                    if (_value_length(raw[start:stop]) if r.value_only else stop - start) >= r.least:
                        found.append((start, rule, stop))
        return sorted(found)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of every rule in ``text``, by start and then by the order of the rules."""
    kinds = [r.kind for r in rules]
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = scanner(rules).scan
        for batch in batches:
            yield pa.array([[{"kind": kinds[k], "start": a, "end": b} for a, k, b in scan(x.as_py())] for x in batch], pa.list_(item))

    return spans(text)


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the array column ``out`` of the spans found in ``text``."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, secret_spans(F.col(text), rules))


def _covered(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with every maximal run of overlapping spans replaced by ``mask``."""
    parts, at, k = [], 0, 0
    while k < len(spans):
        a, b = spans[k]
        while k < len(spans) and spans[k][0] < b:
            b = max(b, spans[k][1])
            k += 1
        parts += [text[at:a], mask]
        at = b
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every maximal run of overlapping secrets in ``text`` replaced, and their former spans; null stays null.

    One function scans and masks, so a task runs one Python worker.
    """
    bounded_batches(docs.sparkSession)
    kinds = [r.kind for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    made = pa.struct([("text", pa.string()), ("spans", pa.list_(span))])

    @F.arrow_udf(f"struct<text:string,spans:{SPANS}>")
    def masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = scanner(rules).scan
        for batch in batches:
            rows = []
            for x in batch:
                t = x.as_py()
                found = scan(t)
                listed = [{"kind": kinds[k], "start": a, "end": b} for a, k, b in found]
                rows.append({"text": _covered(t, [(a, b) for a, _, b in found], mask) if found else t, "spans": listed})
            yield pa.array(rows, made)

    (both,) = fresh(docs, "_masked")
    return docs.withColumn(both, masked(F.col(text))).withColumns({text: F.col(both)["text"], out: F.col(both)["spans"]}).drop(both)
