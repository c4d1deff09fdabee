"""Raw artifacts read back from, and documents written for, the harness tables, each with its oracle SQL."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import json_values
from cadastra.sinks import documents
from cadastra.sources import artifacts, fixed_width, pages


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors see the same files."""
    conf = spark.sparkContext.getConf()
    shared = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not shared and not conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return os.path.join(shared or os.path.join(tempfile.gettempdir(), "cadastra"), f"{name}-{uuid.uuid4().hex}")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """One text per nation: an array, JSON lines with a broken line, or a single object."""
    c = _t(spark, d, "customer").withColumn("j", F.to_json(F.struct("c_custkey", "c_name", "c_nationkey")))
    per = c.groupBy(F.col("c_nationkey").alias("uri")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", "j"))).alias("rows"))
    js = F.transform("rows", lambda r: r["j"])
    lines = F.concat(F.lit("\n"), F.array_join(js, "\r\n"), F.lit("\n{broken\n"))
    text = F.when(F.col("uri") % 3 == 0, F.concat(F.lit("["), F.array_join(js, ", "), F.lit("]"))).when(F.col("uri") % 3 == 1, lines).otherwise(js[0])
    return per.select("uri", text.alias("text"))


def q_json_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Records of arrays, JSON lines and single objects with line numbers; a broken line is a reject."""
    r = artifacts.json_records(_texts(spark, d))
    return r.select("uri", F.col("line").cast("string").alias("line"), F.get_json_object("record", "$.c_custkey").alias("c_custkey"), "error")


def q_zip_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Zips of one file per customer and one that is no data: entries are read in order, a broken zip is a reject."""
    c = _t(spark, d, "customer").withColumn("j", F.to_json(F.struct("c_custkey", "c_name")))
    per = c.groupBy(F.col("c_nationkey").alias("path")).agg(F.sort_array(F.collect_list(F.struct("c_custkey", "j"))).alias("rows"))
    names = F.concat(F.transform("rows", lambda r: F.format_string("data/%07d.json", r["c_custkey"])), F.array(F.lit("readme.txt")))
    zips = per.select("path", artifacts.zipped(names, F.concat(F.transform("rows", lambda r: r["j"]), F.array(F.lit("x")))).alias("content"))
    broken = zips.select((F.col("path") + 1000).alias("path"), F.lit("no zip").cast("binary").alias("content"))
    read = artifacts.unzip(zips.unionAll(broken.where("path < 1002")))
    return read.select("path", "entry", F.get_json_object("text", "$.c_name").alias("c_name"), "error")


def q_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Records out of arrays, wrapping objects and single objects; summaries without a name give none."""
    c = _t(spark, d, "customer").where("c_custkey <= 60").withColumn("j", F.to_json(F.struct("c_custkey", "c_name")))
    k = F.col("c_custkey") % 5
    wrap = lambda a, b: F.concat(F.lit(a), F.col("j"), F.lit(b))
    record = F.when(k == 0, wrap("[", ",{\"x\":1}]")).when(k == 1, wrap('{"businesses":[', "]}")).when(k == 2, wrap('{"data":{"items":[', "]}}")).when(k == 3, F.lit('{"run":7}')).otherwise(F.col("j"))
    return artifacts.expand(c.select("c_custkey", record.alias("record")), needs="c_name").select("c_custkey", F.get_json_object("record", "$.c_name").alias("c_name"))


def q_inline_relation(spark: SparkSession, d: str) -> DataFrame:
    """Nations joined with a relation that is a JSON parameter."""
    rows = '[{"k":1,"tag":"a"},{"k":3,"tag":"b"},{"k":99,"tag":"c"},{"k":3,"tag":null}]'
    return artifacts.inline_relation(spark, rows, "k:int,tag:string").join(_t(spark, d, "nation"), F.col("k") == F.col("n_nationkey")).select("n_name", "tag")


def q_manifest_ids(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("propertyId"), F.sha2("c_name", 256).alias("cid"), F.col("c_nationkey").alias("g"))
    made = c.groupBy("g").agg(F.collect_list(F.struct("propertyId", "cid")).alias("entries")).select(F.to_json(F.struct("entries")).alias("text"))
    return artifacts.manifest_ids(made)


def q_component_file(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a fixed-width component with header, trailer, short, long and malformed lines: fields and first reject reason."""
    return fixed_width.read_component(_component_lines(spark, d), fixed_width.ASSUMED_OLD_NAME).select(
        "file", "line", "file_number", F.col("cancellation_date").cast("string").alias("cancellation_date"), "assumed_old_name", "reject"
    )


def _component_lines(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").where("c_custkey <= 500")
    k = F.col("c_custkey")
    day = F.when(k % 7 == 0, "20230229").when(k % 7 == 1, "00000000").otherwise(F.date_format(F.date_add(F.lit("2001-02-03").cast("date"), k.cast("int")), "yyyyMMdd"))
    number = F.when(k % 13 == 0, "12A45678").otherwise(F.lpad(k.cast("string"), 8, "0"))
    body = F.concat(number, day, F.lit("20240101"), F.lit("1"), F.lit("99999999"), F.col("c_name"), F.when(k % 11 == 0, F.lpad(F.lit(""), 300, "x")).otherwise(""))
    file = F.concat(F.lit("f"), (k % 4).cast("string"))
    data = c.select(file.alias("file"), (k + 2).alias("line"), body.alias("value"))
    n = data.groupBy("file").agg(F.count("*").alias("n"))
    head = n.select("file", F.lit(1).cast("bigint").alias("line"), F.lit("HEADER").alias("value"))
    tail = n.select("file", F.lit(1000000).cast("bigint").alias("line"), F.concat(F.lit("TRAILER"), F.lpad((F.col("n") + F.when(F.col("file") == "f3", 1).otherwise(0)).cast("string"), 8, "0")).alias("value"))
    return data.unionByName(head).unionByName(tail)


def q_component_controls(spark: SparkSession, d: str) -> DataFrame:
    """Counts of trailers against the lines of each file."""
    return fixed_width.control_report(_component_lines(spark, d).where(F.length("value") <= 222), fixed_width.ASSUMED_OLD_NAME)


def q_key_groups(spark: SparkSession, d: str) -> DataFrame:
    """Rows per key of each file and whether a key follows a greater one."""
    li = _t(spark, d, "lineitem").select(F.col("l_linenumber").cast("string").alias("file"), F.col("l_orderkey").alias("line"), (F.col("l_orderkey") % 1000).alias("k"))
    return fixed_width.groups(li.where("k < 3 or line < 1500"), "k")


def q_html_links(spark: SparkSession, d: str) -> DataFrame:
    """Addresses in the attributes of pages, resolved against the page."""
    return pages.links(_t(spark, d, "pages"), "page_id").groupBy("page_id").agg(F.count("*").alias("n"), F.min("link").alias("first"), F.max("link").alias("last"))


def q_html_extract(spark: SparkSession, d: str) -> DataFrame:
    """Of pictures that differ in width only the widest, and a labelled value."""
    c = _t(spark, d, "customer").where("c_custkey <= 300")
    k = F.col("c_custkey").cast("string")
    html = F.concat(F.lit('<td>Folio ID:</td> <td><b> '), F.col("c_name"), F.lit(' &amp; co</b></td><img src="/img/'), k, F.lit('.jpg?Width=100&amp;v=2"><a href=\'pic.png\'>'), F.lit('<img src="/img/'), k, F.lit('.jpg?Width='), (F.col("c_custkey") % 200).cast("string"), F.lit('&v=2"><img src="data:x">'))
    made = c.select("c_custkey", F.lit("https://a.example/dir/page.html?x=1").alias("url"), html.alias("html"))
    best = pages.widest(pages.links(made, "c_custkey"), "c_custkey")
    return best.join(made.select("c_custkey", pages.labelled(F.col("html"), "Folio ID").alias("folio")), "c_custkey").select("c_custkey", "link", F.col("width").cast("string").alias("width"), "folio")


def q_documents(spark: SparkSession, d: str) -> DataFrame:
    """Customers as nested documents with their orders: count of children and digest of each document."""
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    e = _t(spark, d, "events").where("event_type = 'click'").select(F.col("user_id").alias("c_custkey"), "event_id")
    doc = documents.nested(c, "c_custkey", {"orders": (o, ["o_orderkey"]), "clicks": (e, ["event_id"])})
    return documents.as_json(doc, "c_custkey").select("c_custkey", "sha256", "bytes")


def q_documents_manifest(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return documents.manifest(documents.as_json(c, "c_custkey"))


def q_rank_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of 100 rows by rank of the name, ranks made without gathering the rows."""
    c = _t(spark, d, "customer").select("c_name", "c_custkey")
    return documents.shard_index(documents.ranked(c, "c_name", work_folder(spark, "ranks")), "c_name", 100)


def q_stage_rows(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").where("event_id <= 500")
    return documents.stage_rows(e, "events", "event_id", F.concat(F.lit('{"z":1.0,"props":'), F.col("props"), F.lit("}")))


def q_tree_digest(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select(F.col("c_name").alias("path"), F.sha2("c_mktsegment", 256).alias("sha256"), F.col("c_custkey").alias("bytes"))
    return documents.digest(c, groups=16)


def q_upload_decisions(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("cid"))
    known = c.where("c_custkey % 2 = 0").withColumn("cid", F.when(F.col("c_custkey") % 6 == 0, F.lit(None)).when(F.col("c_custkey") % 10 == 0, "other").otherwise(F.col("cid")))
    return documents.upload_decision(known, c.where("c_custkey % 5 <> 3"), "c_custkey")


def q_key_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Every key of nested JSON with its occurrences and the rows that have it."""
    made = F.concat(F.lit('{"a":'), F.col("props"), F.when(F.col("event_id") % 3 == 0, ',"b":[{"k":1},{"c":{"k":2}}]').otherwise(""), F.lit("}"))
    keys = _t(spark, d, "events").select("event_id", F.explode(json_values.all_keys(made)).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_rows"))


ORACLE = {
    "q_json_artifacts": """WITH c AS (SELECT c_nationkey AS uri, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT uri, CASE WHEN uri % 3 = 1 THEN CAST(r + 1 AS VARCHAR) END AS line, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS VARCHAR) AS error FROM c WHERE uri % 3 <> 2 OR r = 1
UNION ALL SELECT uri, CAST(n + 2 AS VARCHAR), NULL, 'no JSON' FROM c WHERE uri % 3 = 1 AND r = 1""",
    "q_zip_artifacts": """SELECT c_nationkey AS path, printf('data/%07d.json', c_custkey) AS entry, c_name, CAST(NULL AS VARCHAR) AS error FROM customer
UNION ALL SELECT DISTINCT c_nationkey + 1000, NULL, NULL, 'BadZipFile' FROM customer WHERE c_nationkey < 2""",
    "q_envelopes": "SELECT c_custkey, c_name FROM customer WHERE c_custkey <= 60 AND c_custkey % 5 <> 3 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey <= 60 AND c_custkey % 5 = 0",
    "q_inline_relation": "SELECT n_name, tag FROM (VALUES (1, 'a'), (3, 'b'), (99, 'c'), (3, NULL)) t(k, tag) JOIN nation ON k = n_nationkey",
    "q_manifest_ids": 'SELECT CAST(c_custkey AS VARCHAR) AS "propertyId", sha256(c_name) AS cid FROM customer',
    "q_component_file": """WITH c AS (SELECT *, CAST(c_custkey AS BIGINT) AS k FROM customer WHERE c_custkey <= 500)
SELECT 'f' || CAST(k % 4 AS VARCHAR) AS file, k + 2 AS line, CASE WHEN k % 13 <> 0 THEN lpad(CAST(k AS VARCHAR), 8, '0') END AS file_number,
CASE WHEN k % 7 > 1 THEN CAST(DATE '2001-02-03' + CAST(k AS INTEGER) AS VARCHAR) END AS cancellation_date, CASE WHEN k % 11 = 0 THEN rpad(c_name, 189, 'x') ELSE c_name END AS assumed_old_name,
CASE WHEN k % 11 = 0 THEN 'too_long' WHEN k % 13 = 0 THEN 'file_number: numeric' WHEN k % 7 = 0 THEN 'cancellation_date: date' END AS reject FROM c""",
    "q_component_controls": """WITH c AS (SELECT 'f' || CAST(c_custkey % 4 AS VARCHAR) AS file, count(*) FILTER (c_custkey % 11 <> 0) AS lines, count(*) + CASE WHEN min(c_custkey % 4) = 3 THEN 1 ELSE 0 END AS stated FROM customer WHERE c_custkey <= 500 GROUP BY 1)
SELECT *, lines = stated AS ok FROM c""",
    "q_key_groups": """WITH l AS (SELECT CAST(l_linenumber AS VARCHAR) AS file, l_orderkey AS line, l_orderkey % 1000 AS k FROM lineitem), b AS (SELECT file, k, k < lag(k) OVER (PARTITION BY file ORDER BY line) AS back FROM l WHERE k < 3 OR line < 1500)
SELECT file, k, count(*) AS n, NOT bool_or(coalesce(back, false)) AS in_order FROM b GROUP BY 1, 2""",
    "q_html_links": r"""WITH r AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)\b(?:src|href)\s*=\s*["'']([^"'']+)["'']', 1)) AS raw FROM pages),
u AS (SELECT page_id, trim(replace(raw, '&amp;', '&')) AS x, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host, regexp_extract(url, '^(https?://[^?#]*/)', 1) AS folder FROM r),
a AS (SELECT page_id, CASE WHEN regexp_matches(x, '(?i)^https?://') THEN x WHEN starts_with(x, '//') THEN 'https:' || x WHEN regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(x, '/') THEN host || x WHEN NOT starts_with(x, '#') THEN CASE folder WHEN '' THEN host || '/' ELSE folder END || regexp_replace(x, '^(?:\./)+', '') END AS link FROM u)
SELECT page_id, count(*) AS n, min(link) AS first, max(link) AS last FROM a WHERE link IS NOT NULL GROUP BY 1""",
    "q_html_extract": """WITH c AS (SELECT c_custkey, c_name || ' & co' AS folio, c_custkey % 200 AS w FROM customer WHERE c_custkey <= 300)
SELECT c_custkey, 'https://a.example/img/' || CAST(c_custkey AS VARCHAR) || '.jpg?Width=' || CAST(greatest(w, 100) AS VARCHAR) || '&v=2' AS link, CAST(greatest(w, 100) AS VARCHAR) AS width, folio FROM c
UNION ALL SELECT c_custkey, 'https://a.example/dir/pic.png', NULL, folio FROM c""",
    "q_documents": """WITH o AS (SELECT o_custkey AS k, string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey) AS a FROM orders GROUP BY 1),
e AS (SELECT user_id AS k, string_agg('{"event_id":' || event_id || '}', ',' ORDER BY event_id) AS a FROM events WHERE event_type = 'click' GROUP BY 1),
j AS (SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","orders":[' || coalesce(o.a, '') || '],"clicks":[' || coalesce(e.a, '') || ']}' AS doc FROM customer LEFT JOIN o ON o.k = c_custkey LEFT JOIN e ON e.k = c_custkey)
SELECT c_custkey, sha256(doc) AS sha256, CAST(strlen(doc) AS BIGINT) AS bytes FROM j""",
    "q_documents_manifest": """WITH j AS (SELECT strlen('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}') AS b FROM customer)
SELECT count(*) AS n, CAST(sum(b) AS BIGINT) AS total, min(b) AS least, round(avg(b), 2) AS mean, max(b) AS greatest, round(avg(b) * 1000000, 0) AS per_million FROM j""",
    "q_rank_shards": "SELECT CAST((r - 1) // 100 AS BIGINT) AS shard, min(c_name) AS first_key, max(c_name) AS last_key, count(*) AS n FROM (SELECT c_name, row_number() OVER (ORDER BY c_name) AS r FROM customer) GROUP BY 1",
    "q_stage_rows": """WITH j AS (SELECT event_id, '{"props":{"k":' || json_extract_string(props, '$.k') || '},"z":1}' AS v FROM events WHERE event_id <= 500)
SELECT 'events' AS table_name, CAST(event_id AS VARCHAR) AS source_record_key, v AS values_json, sha256(v) AS source_record_hash FROM j""",
    "q_upload_decisions": """SELECT c_custkey, CASE WHEN c_custkey % 2 <> 0 THEN 'new' WHEN c_custkey % 6 = 0 THEN 'unverifiable' WHEN c_custkey % 10 = 0 THEN 'changed' ELSE 'skip' END AS decision FROM customer WHERE c_custkey % 5 <> 3""",
    "q_key_inventory": """WITH k AS (SELECT event_id, 'a' AS key, 1 AS n FROM events UNION ALL SELECT event_id, 'k', 1 + CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END FROM events UNION ALL SELECT event_id, x, 1 FROM events, (VALUES ('b'), ('c')) t(x) WHERE event_id % 3 = 0)
SELECT key, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT event_id) AS n_rows FROM k GROUP BY 1""",
}


def queries() -> dict:
    return {k: globals()[k] for k in [*ORACLE, "q_tree_digest"]}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
