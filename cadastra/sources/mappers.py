"""Row mappers: JSON records of artifacts become typed rows of record tables, by declared fields.

A rule names the files that it reads, the table and the fields (column, kind, alias paths).  All rules read one frame of
(folio, file, record); each table is one native projection of the rows that its rules match, and files that no rule matches are
kept as rejects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import json_values, names, readers

_KINDS = {"text": lambda c: c, "number": readers.number, "integer": readers.integer, "boolean": readers.boolean, "date": readers.date, "timestamp": readers.timestamp}


@dataclass(frozen=True)
class Field:
    column: str
    kind: str = "text"
    paths: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    files: str
    table: str
    fields: tuple[Field, ...]


def singular(table: str) -> str:
    """The class name of a table in keys: ``ies`` becomes ``y``, another final ``s`` goes, so taxes give ``taxe``."""
    return f"{table[:-3]}y" if table.endswith("ies") else table.removesuffix("s")


def values(record: Column, fields: tuple[Field, ...]) -> list[Column]:
    """Typed columns of a JSON text; the first alias path with a value counts, the column's own name without paths."""
    return [_KINDS[f.kind](json_values.first_text(record, *(f.paths or (f.column,)))).alias(f.column) for f in fields]


def source_key(system: Column, folio: Column, kind: str, file: Column) -> Column:
    return F.concat_ws(":", system, folio, F.lit(kind), F.regexp_replace(F.regexp_replace(file, "^.*/", ""), r"\.json$", ""))


def parent_key(system: Column, folio: Column) -> Column:
    return F.concat_ws(":", system, folio, F.lit("property"), F.lit("property"))


def mapped(records: DataFrame, rules: tuple[Rule, ...], system: str) -> dict[str, DataFrame]:
    """Table name -> rows with keys, payload hash and typed fields; ``rejects`` holds files without a rule."""
    s, out, known = F.lit(system), {}, F.lit(False)
    for r in rules:
        hit = F.coalesce(F.col("file").rlike(r.files), F.lit(False))
        rows = records.where(hit & ~known).select(
            s.alias("source_system"), source_key(s, F.col("folio"), singular(r.table), F.col("file")).alias("source_record_key"), parent_key(s, F.col("folio")).alias("property_key"), F.col("folio").alias("request_identifier"),
            json_values.json_hash(F.col("record")).alias("source_record_hash"), *values(F.col("record"), r.fields),
        )
        out[r.table] = out[r.table].unionByName(rows, allowMissingColumns=True) if r.table in out else rows
        known = known | hit
    return out | {"rejects": records.where(~known).select("folio", "file")}


def tax_valuations(taxes: DataFrame) -> DataFrame:
    """A valuation per tax row with a market or assessed value, on the first day of its year."""
    value = F.coalesce("property_market_value_amount", "property_assessed_value_amount")
    day = F.when(F.col("tax_year").isNotNull(), F.format_string("%04d-01-01", "tax_year"))
    key = F.regexp_replace("source_record_key", "^([^:]*:[^:]*):taxe:", "$1:property_valuation:")
    return taxes.where(value.isNotNull()).select(key.alias("source_record_key"), "property_key", "request_identifier", value.alias("current_avm_value"), day.alias("valuation_date"))


#: Words of a name that mark a company, and suffixes of persons.
_COMPANY = r"\b(?:LLC|INC|CORP|CORPORATION|CO|COMPANY|LTD|LP|LLP|TRUST|BANK|ASSOCIATION|CHURCH|CITY|COUNTY|STATE)\b"
_SUFFIX = r" (JR|SR|II|III|IV|V)$"


def owner(value: Column) -> Column:
    """(kind, first, middle, last, suffix, name) of an owner's name: a company by its words, else a person."""

    def read(n: Column) -> Column:
        suffix = F.nullif(F.regexp_extract(n, _SUFFIX, 1), F.lit(""))
        ws = F.split(F.regexp_replace(n, _SUFFIX, ""), " ")
        person = ~n.rlike(_COMPANY) & (F.size(ws) >= 2)
        middle = F.nullif(F.array_join(F.slice(ws, F.lit(2), F.greatest(F.size(ws) - 2, F.lit(0))), " "), F.lit(""))
        only = lambda c: F.when(person, c)
        return F.struct(F.when(person, "person").otherwise("company").alias("kind"), only(F.get(ws, F.lit(0))).alias("first"), only(middle).alias("middle"), only(F.try_element_at(ws, F.lit(-1))).alias("last"), only(suffix).alias("suffix"), n.alias("name"))

    return readers.let(names.name(value), lambda n: F.when(n != "", read(n)))


def children(rows: DataFrame, key: str, record: str, path: str, fields: tuple[Field, ...], identity: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per entry of an array in a record, with its ordinal from 0; of entries with one identity the first."""
    listed = F.from_json(F.get_json_object(record, f"$.{path}"), "array<string>")
    out = rows.select(key, F.posexplode(listed).alias("ordinal", "_e")).select(key, "ordinal", *values(F.col("_e"), fields))
    if not identity:
        return out
    rest = [c for c in out.columns if c not in (key, *identity)]
    return out.groupBy(key, *identity).agg(F.min_by(F.struct(*rest), "ordinal").alias("_r")).select(key, *identity, "_r.*")


def places(records: DataFrame, key: str, record: str = "record") -> dict[str, DataFrame]:
    """Places whose datasets all have an approved licence, with categories and sources as rows; others are rejects."""
    from cadastra.functions import scores

    sources = F.from_json(F.get_json_object(record, "$.sources"), "array<struct<dataset:string,record_id:string,property:string>>")
    read = records.withColumn("_s", sources).withColumn("_gate", scores.dataset_gate(F.transform(F.coalesce("_s", F.array().cast("array<struct<dataset:string,record_id:string,property:string>>")), lambda x: x["dataset"])))
    good = read.where("_gate.passed")
    primary, more = F.get_json_object(record, "$.categories.primary"), F.from_json(F.get_json_object(record, "$.categories.alternate"), "array<string>")
    kinds = F.array_compact(F.concat(F.array(primary), F.coalesce(more, F.array().cast("array<string>"))))
    return {
        "locations": good.select(key, json_values.first_text(F.col(record), "names.primary", "name").alias("name"), readers.number(F.get_json_object(record, "$.confidence")).alias("confidence"), primary.alias("primary_category")),
        "categories": good.select(key, F.posexplode(kinds).alias("ordinal", "category")).withColumn("is_primary", F.col("ordinal") == 0),
        "sources": good.select(key, F.posexplode("_s").alias("ordinal", "s")).select(key, "ordinal", "s.dataset", "s.record_id"),
        "rejects": read.where("not _gate.passed").select(key, F.array_join("_gate.unknown", ",").alias("unknown")),
    }


def link_rows(candidates: DataFrame, parcel: str, more: str, uri: str) -> DataFrame:
    """(parcel_id, uri, folio): every normalised parcel id of a candidate with its artifact, each pair once."""
    from cadastra.functions import addresses

    ids = candidates.select(F.explode(F.concat(F.array(parcel), F.coalesce(more, F.array().cast("array<string>")))).alias("raw"), F.col(uri).alias("uri"))
    return ids.select(addresses.parcel_id(F.col("raw")).alias("parcel_id"), "uri", F.nullif(F.regexp_extract("uri", r"(?i)folio-(\d+)", 1), F.lit("")).alias("folio")).where("parcel_id is not null").distinct()


def scope_sets(manifest: DataFrame, text: str = "text") -> dict[str, DataFrame]:
    """The distinct parcels, artifacts and address bases of scope manifests."""
    rows = manifest.select(F.inline(F.from_json(F.get_json_object(text, "$.candidates"), "array<struct<parcelIdentifier:string,appraisalOutputS3Uri:string,addressBase:string>>")))
    one = lambda c: rows.select(readers.text(F.col(c)).alias(c)).where(F.col(c).isNotNull()).distinct()
    return {"parcels": one("parcelIdentifier"), "artifacts": one("appraisalOutputS3Uri"), "bases": one("addressBase")}
