"""Raw artifacts as DataFrames: listings, zips, JSON and JSON lines, envelopes, manifests; what cannot be read becomes a reject row."""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "array<struct<line:bigint,record:string,error:string>>"
ENTRIES = "array<struct<entry:string,text:string,error:string>>"
#: The part of an artifact's zip that holds records, and the arrays that envelopes wrap records in.
DATA_ENTRY = r"^data/.+\.json$"
ENVELOPES = ("businesses", "profiles", "results", "items", "data.businesses", "data.profiles", "data.results", "data.items")


def list_files(spark: SparkSession, folder: str, glob: str = "*", limit: int | None = None) -> DataFrame:
    """(path, length, modificationTime) of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    listed = files.select("path", "length", "modificationTime")
    return listed.orderBy("path").limit(limit) if limit else listed


def read_zips(spark: SparkSession, folder: str, glob: str = "*.zip", keep: str = DATA_ENTRY) -> DataFrame:
    """(path, entry, text, error) of the matching entries of all zips below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return unzip(files.select("path", "content"), keep)


def unzip(zips: DataFrame, keep: str = DATA_ENTRY) -> DataFrame:
    """(path, entry, text, error): entries in order of name; a broken zip or entry gives one row with an error.

    A zip is read as a whole by one task, an entry is one row; an unreadable zip does not fail the job.
    """

    def read(raw: bytes | None) -> list[dict]:
        out = []
        try:
            with zipfile.ZipFile(io.BytesIO(raw or b"")) as z:
                for name in sorted(n for n in z.namelist() if re.search(keep, n)):
                    try:
                        out.append({"entry": name, "text": z.read(name).decode(), "error": None})
                    except (UnicodeDecodeError, zipfile.BadZipFile, zlib.error) as e:
                        out.append({"entry": name, "text": None, "error": type(e).__name__})
        except zipfile.BadZipFile as e:
            out.append({"entry": None, "text": None, "error": type(e).__name__})
        return out

    @F.arrow_udf(ENTRIES)
    def entries(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([(c, pa.string()) for c in ("entry", "text", "error")]))
        for batch in batches:
            yield pa.array([read(x.as_py()) for x in batch], kind)

    return zips.select("path", F.inline(entries(F.col("content"))))


def zipped(names: Column, texts: Column) -> Column:
    """A zip of named texts, the same bytes for the same input."""

    @F.arrow_udf("binary")
    def made(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for ns, ts in batches:
            out = []
            for n, t in zip(ns.to_pylist(), ts.to_pylist()):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, text in zip(n or [], t or []):
                        z.writestr(zipfile.ZipInfo(name), text or "")
                out.append(held.getvalue())
            yield pa.array(out, pa.binary())

    return made(names, texts)


def parse_records(text: str | None, form: str = "auto") -> list[dict]:
    """Records of a JSON text: the entries of an array, one object, or, where the whole is no JSON, a record per line."""
    text = text or ""
    row = lambda line, record, error=None: {"line": line, "record": record, "error": error}
    written = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    if form != "jsonl":
        try:
            whole = json.loads(text)
            return [row(None, written(x)) for x in (whole if isinstance(whole, list) else [whole])]
        except ValueError:
            if form == "json":
                return [row(None, None, "no JSON")]
    out = []
    for k, line in enumerate(re.split(r"\r?\n", text), 1):
        if line.strip():
            try:
                out.append(row(k, written(json.loads(line))))
            except ValueError:
                out.append(row(k, None, "no JSON"))
    return out


def json_records(texts: DataFrame, form: str = "auto", text: str = "text") -> DataFrame:
    """The columns of ``texts`` but the text, with line, record and error of each record."""

    @F.arrow_udf(RECORDS)
    def records(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("line", pa.int64()), ("record", pa.string()), ("error", pa.string())]))
        for batch in batches:
            yield pa.array([parse_records(x.as_py(), form) for x in batch], kind)

    return texts.select(*[c for c in texts.columns if c != text], F.inline(records(F.col(text))))


def read_json(spark: SparkSession, path: str, form: str = "auto") -> DataFrame:
    """(uri, line, record, error) of JSON or JSON lines files; lines of known JSON lines files are split by the reader."""
    if form == "jsonl":
        lines = spark.read.text(path).select(F.input_file_name().alias("uri"), F.col("value").alias("text")).where(F.trim("text") != "")
        return json_records(lines, "json")
    return json_records(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("uri"), F.col("value").alias("text")), form)


def single_object(text: Column) -> Column:
    """The one object of a side file; null unless it holds exactly one line that is an object."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")
    first = F.get(lines, F.lit(0))
    return F.when((F.size(lines) == 1) & F.trim(first).startswith("{") & F.get_json_object(first, "$").isNotNull(), first)


def expand(records: DataFrame, record: str = "record", envelopes: tuple[str, ...] = ENVELOPES, needs: str | None = None) -> DataFrame:
    """One row per record of an envelope: an array, an object that wraps one, or the object itself.

    With ``needs`` an object without that field, such as a run's summary, gives no row.
    """
    items = lambda x: F.from_json(x, "array<string>")
    whole = F.when(F.ltrim(F.col(record)).startswith("["), items(F.col(record)))
    inner = [F.when(F.get_json_object(record, f"$.{e}").startswith("["), items(F.get_json_object(record, f"$.{e}"))) for e in envelopes]
    alone = F.col(record).isNotNull() if needs is None else F.get_json_object(record, f"$.{needs}").isNotNull()
    listed = F.coalesce(whole, *inner, F.when(alone, F.array(F.col(record))), F.array().cast("array<string>"))
    return records.withColumn(record, F.explode(listed))


def inline_relation(spark: SparkSession, rows: str, schema: str) -> DataFrame:
    """Rows of a JSON array given as a parameter."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), f"array<struct<{schema}>>")))


def manifest_ids(manifests: DataFrame, entries: str = "entries", key: str = "propertyId", value: str = "cid", text: str = "text") -> DataFrame:
    """(key, value) of the entries of manifests; entries without a key are left out."""
    listed = F.from_json(F.get_json_object(text, f"$.{entries}"), f"array<struct<{key}:string,{value}:string>>")
    return manifests.select(F.inline(listed)).where(F.col(key).isNotNull())


def read_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The distinct non-blank values of one column of CSV (with header), JSON lines or Parquet files."""
    kind = "csv" if path.endswith(".csv") else "json" if path.endswith((".json", ".jsonl")) else "parquet"
    found = spark.read.option("header", True).option("nullValue", "").format(kind).load(path)
    return found.select(F.trim(F.col(column).cast("string")).alias(column)).where(f"{column} <> ''").distinct()
