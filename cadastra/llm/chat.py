"""Chat formatting: rendered turns are parsed again and escaped until the parse is identical.

Grammar: a turn is ``<|turn|>`` role ``|`` mode newline content ``<|end|>`` newline, with mode
``r`` (raw) or ``e`` (escaped).  A turn is rendered raw, reparsed and compared; one whose content
conflicts is escaped (``~`` to ``~0``, ``<|`` to ``~1``, so no control string is left), which
always parses to the source.  All steps are native expressions and run per turn; only finished
turns are gathered per conversation, whose output is one string by contract.

The whole conversation is parsed once more and compared with its turns; a difference raises an error.

Defined cases: null role or text is empty; turns sort by turn, role, text, null turns first;
repeated rows are repeated turns; rows without a conv_id form one conversation; an empty table has no
conversations; a text of any length is one turn; other columns have no place in a conversation and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("~1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def render(role: Column, text: Column, mode: str) -> Column:
    role = F.replace(F.replace(F.replace(escape(role), F.lit("|"), F.lit("~2")), F.lit("\n"), F.lit("~3")), F.lit("<"), F.lit("~4"))
    return F.concat(F.lit(OPEN), role, F.lit(f"|{mode}\n"), escape(text) if mode == "e" else text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns (role, text, chars in the output) of a formatted string, by the grammar alone."""
    parts = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(head) + 2)
        role = F.substr(F.substring_index(head, "|", 2 + 1), F.lit(len(OPEN) + 1))
        for code, char in (("~4", "<"), ("~3", "\n"), ("~2", "|")):
            role = F.replace(role, F.lit(code), F.lit(char))
        return F.struct(unescape(role).alias("role"), F.when(F.endswith(head, F.lit("|e")), unescape(body)).otherwise(body).alias("text"), F.length(body).alias("chars"))

    return F.transform(parts, turn)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, its parsed turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    raw = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    raw = raw.withColumn("raw", render(F.col("role"), F.col("text"), "r"))
    parsed = parse(F.col("raw"))
    same = (F.size(parsed) == 1) & (parsed[0]["role"] == F.col("role")) & (parsed[0]["text"] == F.col("text")) & ~F.contains(F.col("text"), F.lit("<|"))
    done = raw.withColumn("out", F.when(F.coalesce(same, F.lit(False)), F.col("raw")).otherwise(render(F.col("role"), F.col("text"), "e")))
    gathered = done.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("t"))
    formatted = gathered.select("conv_id", "t", F.array_join(F.transform("t", lambda x: x["out"]), "").alias("formatted")).withColumn("turns", parse(F.col("formatted")))
    pair = lambda turns: F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    checked = F.when(pair("turns") == pair("t"), F.col("turns")).otherwise(F.raise_error(F.lit("a formatted conversation does not parse to its turns")))
    return formatted.select("conv_id", "formatted", checked.alias("turns"))
