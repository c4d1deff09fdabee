"""JSON text: canonical form, aliases, coordinates, rings and key walks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import readers


def _number(x: float) -> str:
    """The shortest decimal text of a double, as JSON of the web writes it."""
    if x == 0:
        return "0"
    sign, digits, power = Decimal(repr(x)).normalize().as_tuple()
    d, n = "".join(map(str, digits)), len(digits) + power
    if len(d) <= n <= 21:
        out = d + "0" * (n - len(d))
    elif 0 < n <= 21:
        out = f"{d[:n]}.{d[n:]}"
    elif -6 < n <= 0:
        out = f"0.{'0' * -n}{d}"
    else:
        out = f"{d[0]}{'.' + d[1:] if len(d) > 1 else ''}e{'+' if n > 0 else '-'}{abs(n - 1)}"
    return "-" * sign + out


def _written(x) -> str:
    if isinstance(x, dict):
        return "{" + ",".join(f"{_written(k)}:{_written(x[k])}" for k in sorted(x, key=lambda k: k.encode("utf-16-be", "surrogatepass"))) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_written, x)) + "]"
    return _number(x) if isinstance(x, float) else json.dumps(x, ensure_ascii=False)


def _refuse(name: str):
    raise ValueError(name)


def canonical(text: str | None) -> str | None:
    """The same JSON with sorted keys and numbers in shortest form; null for text that is no JSON."""
    try:
        return None if text is None else _written(json.loads(text, parse_int=float, parse_constant=_refuse))
    except ValueError:
        return None


def canonical_json(value: Column) -> Column:
    """Key order of any depth has no native form, so this walk is an Arrow function."""

    @F.arrow_udf("string")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([canonical(x.as_py()) for x in batch], pa.string())

    return made(value)


def json_hash(value: Column) -> Column:
    return F.sha2(canonical_json(value), 256)


def keys_of(text: str | None) -> list[str]:
    """Every object key of a JSON text, at any depth, with repeats."""
    out, todo = [], []
    try:
        todo = [json.loads(text)] if text else []
    except ValueError:
        pass
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            out += x
            todo += x.values()
        elif isinstance(x, list):
            todo += x
    return sorted(out)


def all_keys(value: Column) -> Column:
    @F.arrow_udf("array<string>")
    def walked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([keys_of(x.as_py()) for x in batch], pa.list_(pa.string()))

    return walked(value)


def denied_keys(value: Column, denied: str) -> Column:
    """The distinct keys of a JSON text that a pattern denies."""
    return F.array_distinct(F.filter(all_keys(value), lambda k: k.rlike(denied)))


def first_text(payload: Column, *paths: str) -> Column:
    """The first non-blank text among alias paths (dotted) of a JSON text."""
    return F.coalesce(*[readers.text(F.get_json_object(payload, f"$.{p}")) for p in paths])


def coordinate(payload: Column) -> Column:
    """(longitude, latitude) written as text under ``source_payload``; values out of range give null."""
    raw = lambda *names: F.coalesce(*[F.get_json_object(payload, f"$.source_payload.{x}") for x in names])
    within = lambda v, most: F.when(F.abs(v) <= most, v)
    lon, lat = readers.number(raw("longitude", "X_longitude")), readers.number(raw("latitude", "Y_latitude"))
    return F.struct(within(lon, 180).alias("longitude"), within(lat, 90).alias("latitude"))


def ring(value: Column) -> Column:
    """A closed ring of four positions or more, each of two finite numbers or more; null otherwise."""
    read = F.from_json(value, "array<array<double>>")
    finite = lambda p: (F.size(p) >= 2) & F.forall(p, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    ends = lambda r, k: F.get(F.get(r, F.lit(0)), F.lit(k)) == F.get(F.try_element_at(r, F.lit(-1)), F.lit(k))
    good = lambda r: (F.size(r) >= 4) & F.forall(r, finite) & ends(r, 0) & ends(r, 1)
    return readers.let(read, lambda r: F.when(F.coalesce(good(r), F.lit(False)), r))
