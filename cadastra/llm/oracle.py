"""DuckDB SQL for the text queries that SQL can express, written from their definitions alone."""

from __future__ import annotations

from .quality_rules import LISTED, STOP_WORDS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS, _NOT_WORD = r"[\x20\x09-\x0D]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, separator: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{separator}'), lambda x: x <> '')"


_WINDOWS = "unnest(list_transform(range(0, greatest(len(ws) - {n} + 1, 0)), lambda k: {{'k': k, 'g': array_to_string(ws[k + 1 : k + {n}], ' ')}})) AS s"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words(_LOWER.format("text"), _NOT_WORD)} AS ws FROM documents),
i AS (SELECT CAST(item_id AS varchar) AS item_id, {_words(_LOWER.format("text"), _NOT_WORD)} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM i WHERE len(ws) > 0),
wins AS (SELECT DISTINCT item_id, n, s.g AS g FROM (SELECT item_id, n, {_WINDOWS.format(n="n")} FROM sized)),
sizes AS (SELECT DISTINCT n FROM wins),
dw AS (SELECT r, n, s.k AS k, s.g AS g FROM (SELECT r, n, {_WINDOWS.format(n="n")} FROM d, sizes)),
found AS (SELECT r, dw.n, k, item_id FROM dw JOIN wins ON dw.g = wins.g AND dw.n = wins.n),
hit AS (SELECT r, count(DISTINCT k + o) AS n_hit FROM found, range(0, 10) AS t(o) WHERE o < n GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_words("t", _BLANKS)} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, s.k AS k, s.g AS g FROM (SELECT r, {_WINDOWS.format(n="5")} FROM w)),
twice AS (SELECT r, g FROM g GROUP BY r, g HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT k + o) AS n FROM g JOIN twice USING (r, g), range(0, 5) AS t(o) GROUP BY r),
m AS (SELECT doc_id, lang, t, CAST(len(ws) AS bigint) AS n_words, CAST(length(array_to_string(ws, '')) AS bigint) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines, len(ls) AS n_lines,
  CAST(coalesce(rep.n, 0) AS bigint) AS n_repeat_words, length(regexp_replace(t, '[^!]', '', 'g')) AS shouts,
  len(list_filter(ws, lambda x: translate(lower(x), '.,;:!?#*$%&|<>"''()', '') IN ({_STOPS}))) AS stops,
  length(regexp_replace(t, '[\x00-\x{{24F}}]|[^\pL\pM]|\p{{Latin}}', '', 'g')) AS other, length(regexp_replace(t, '\P{{Latin}}', '', 'g')) AS latin_letters
  FROM w LEFT JOIN rep USING (r)),
c AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, other = 0 OR other <= latin_letters AS latin,
  coalesce(regexp_matches(lang, '{LISTED.replace("(?i:", "(?:")}', 'i'), true) AS named FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (NOT latin OR word_chars BETWEEN 2 * n_words AND 20 * n_words) AND n_symbols / n_words <= 0.3 AND shouts / n_words <= 0.5
  AND n_dup_lines / n_lines <= 0.5 AND (n_words < 60 OR NOT (latin AND named) OR stops / n_words >= 0.01) AS kept
FROM c
"""

CHAT = r"""
WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, '<|turn|>' || replace(replace(replace(replace(replace(role, '~', '~0'), '<|', '~1'), '|', '~2'), chr(10), '~3'), '<', '~4')
  || CASE WHEN contains(text, '<|') THEN '|e' || chr(10) || replace(replace(text, '~', '~0'), '<|', '~1') ELSE '|r' || chr(10) || text END || '<|end|>' || chr(10) AS line FROM rows_)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(line)) AS bigint) AS formatted_chars
FROM o GROUP BY conv_id
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_LOWER.format("text"), _BLANKS)} AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS varchar[]) ELSE list_distinct(list_transform(range(0, greatest(len(ws) - 4, 1)), lambda k: array_to_string(ws[k + 1 : k + 5], ' '))) END AS sh FROM d),
s AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS v FROM g),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS n, count(*) AS c FROM s a JOIN s b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (n - c)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least_ AS (SELECT a AS doc_id, min(b) AS other FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sh) AS bigint) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id, least(doc_id, coalesce(other, doc_id)) = doc_id AS kept
FROM g LEFT JOIN least_ USING (doc_id)
"""

SQL = {"op2_decontamination": DECONTAMINATION, "op3_quality_rules": QUALITY, "op5_chat_formatting": CHAT, "op7_near_dedup": NEAR}
