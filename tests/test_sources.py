"""Readers and writers on files, and digests against hashlib."""

import hashlib
import io
import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from cadastra.sinks import documents
from cadastra.sources import artifacts


def test_files_of_all_kinds(spark, tmp_path):
    (tmp_path / "a").mkdir()
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, text in (("data/b.json", '{"x":1}'), ("data/a.json", "[1]"), ("other.json", "2")):
            z.writestr(name, text)
    (tmp_path / "a" / "one.zip").write_bytes(held.getvalue())
    (tmp_path / "a" / "bad.zip").write_bytes(b"none")
    (tmp_path / "r.jsonl").write_text('{"a":1}\n\nbroken\n{"a":2}\r\n')
    (tmp_path / "r.json").write_text('[{"a":"é"},2]')
    (tmp_path / "ids.csv").write_text("folio,x\n 1 ,a\n1,b\n,c\n2,d\n")
    listed = artifacts.list_files(spark, str(tmp_path), "*.zip")
    assert [r.path.rsplit("/", 1)[1] for r in listed.orderBy("path").collect()] == ["bad.zip", "one.zip"] and listed.columns == ["path", "length", "modificationTime"]
    assert artifacts.list_files(spark, str(tmp_path), "*.zip", 1).count() == 1
    got = [(r.path.rsplit("/", 1)[1], r.entry, r.text, r.error) for r in artifacts.read_zips(spark, str(tmp_path)).orderBy("path", "entry").collect()]
    assert got == [("bad.zip", None, None, "BadZipFile"), ("one.zip", "data/a.json", "[1]", None), ("one.zip", "data/b.json", '{"x":1}', None)]
    lines = artifacts.read_json(spark, str(tmp_path / "r.jsonl"))
    assert [(r.line, r.record, r.error) for r in lines.orderBy("line").collect()] == [(1, '{"a":1}', None), (3, None, "no JSON"), (4, '{"a":2}', None)]
    assert sorted((r.record or "", r.error or "") for r in artifacts.read_json(spark, str(tmp_path / "r.jsonl"), "jsonl").collect()) == [("", "no JSON"), ('{"a":1}', ""), ('{"a":2}', "")]
    assert [r.record for r in artifacts.read_json(spark, str(tmp_path / "r.json")).collect()] == ['{"a":"é"}', "2"]
    assert sorted(r.folio for r in artifacts.read_list(spark, str(tmp_path / "ids.csv"), "folio").collect()) == ["1", "2"]


@pytest.mark.parametrize(("text", "one"), [('{"a":1}\n', True), ('\n{"a":1}\n\n', True), ('{"a":1}\n{"a":2}', False), ("[1]", False), ("", False), (None, False)])
def test_single_object(spark, text, one):
    got = spark.createDataFrame([(text,)], "t string").select(artifacts.single_object(F.col("t")).alias("o"))
    assert (got.first().o is not None) == one


def test_documents_in_shards(spark, tmp_path):
    docs = documents.as_json(spark.createDataFrame([(k, None if k % 2 else "é") for k in range(10)], "id int, name string"), "id")
    documents.write_documents(docs, str(tmp_path / "d"), docs.id % 3)
    lines = [json.loads(x) for p in (tmp_path / "d").rglob("*.txt") for x in p.read_text().splitlines()]
    assert sorted(x["id"] for x in lines) == list(range(10)) and all(set(x) == {"id", "name"} for x in lines)
    assert {p.name for p in (tmp_path / "d").iterdir() if p.is_dir()} == {"shard=0", "shard=1", "shard=2"}


def test_digest_against_hashlib(spark):
    files = [(f"p{k}", f"s{k % 3}", k) for k in range(50)]
    groups = {}
    for p, s, n in files:
        groups.setdefault(zlib.crc32(p.encode()) % 8, []).append(f"{p}|{s}|{n}")
    want = hashlib.sha256("\n".join(hashlib.sha256("\n".join(sorted(groups[g])).encode()).hexdigest() for g in sorted(groups)).encode()).hexdigest()
    frame = spark.createDataFrame(files, "path string, sha256 string, bytes int")
    assert tuple(documents.digest(frame, groups=8).first()) == (want, 50)
    assert documents.digest(frame.where("bytes <> 7"), groups=8).first().digest != want
