"""Counts, histograms, digests and text mappings on the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import keys
from cadastra.plans.artifacts import work_folder
from cadastra.sources import fixed_width
from cadastra.streaming.appends import load_new

#: Keys of one shard of the index.
SHARD = 64


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _n() -> F.Column:
    return F.count("*")


def q_group_by_expr_slug(spark: SparkSession, d: str) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return _t(spark, d, "pages").where(host != "").groupBy(host.alias("host")).agg(_n().alias("n"), F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))


def q_verification_row(spark: SparkSession, d: str) -> DataFrame:
    """Independent counts of several tables as one row; every side is a single aggregate row."""
    o = _t(spark, d, "orders").agg(_n().alias("n_orders"), F.countDistinct("o_custkey").alias("n_buyers"), F.count_if(F.col("o_totalprice") <= 0).alias("n_free"))
    li = _t(spark, d, "lineitem").agg(_n().alias("n_lines"), F.count_if(F.col("l_shipdate").isNull()).alias("n_unshipped"))
    return o.withColumn("k", F.lit(1)).join(li.withColumn("k", F.lit(1)), "k").drop("k")


def q_rows_and_folios(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for table, key in (("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("events", "user_id")):
        one = _t(spark, d, table).agg(F.lit(table).alias("table_name"), _n().alias("n_rows"), F.countDistinct(key).alias("n_folios"))
        out = one if out is None else out.unionByName(one)
    return out


def q_tier_report(spark: SparkSession, d: str) -> DataFrame:
    """The strongest tier of each (user, type), counted by tier."""
    rank = F.when(F.col("value") >= 100, 3).when(F.col("value") >= 50, 2).otherwise(1)
    best = _t(spark, d, "events").groupBy("user_id", "event_type").agg(F.max(rank).alias("r"))
    tier = F.when(F.col("r") == 3, "high").when(F.col("r") == 2, "medium").otherwise("low")
    return best.groupBy(tier.alias("tier")).agg(_n().alias("n"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("event_type").alias("n_types"))


def q_collision_counts(spark: SparkSession, d: str) -> DataFrame:
    pairs = _t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    many = lambda k, name: pairs.groupBy(k).count().agg(F.lit(name).alias("measure"), F.count_if(F.col("count") > 1).alias("n"))
    return many("l_partkey", "parts_of_several_suppliers").unionByName(many("l_suppkey", "suppliers_of_several_parts"))


def q_histogram_topk(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").groupBy("user_id").agg(_n().alias("n")).orderBy(F.desc("n"), "user_id").limit(20)


def q_running_stats(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").groupBy("lang").agg(F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.sum("n_chars").alias("total"), _n().alias("n"))


def q_shard_index(spark: SparkSession, d: str) -> DataFrame:
    shard = F.floor(F.col("c_custkey") / SHARD).alias("shard")
    return _t(spark, d, "customer").groupBy(shard).agg(_n().alias("n"), F.min("c_custkey").alias("first_key"), F.max("c_custkey").alias("last_key"))


def q_ordered_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of the ordered row digests of every shard of items."""
    line = F.concat_ws("|", F.col("item_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = _t(spark, d, "benchmark").groupBy(F.floor(F.col("item_id") / SHARD).alias("shard")).agg(F.sort_array(F.collect_list(F.struct("item_id", line.alias("line")))).alias("x"))
    return rows.select("shard", F.sha2(F.array_join(F.transform("x", lambda x: x["line"]), "\n"), 256).alias("digest"))


def q_json_extract(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return _t(spark, d, "events").select("event_id", k.alias("k"), k.isNotNull().alias("has_k"), F.get_json_object("props", "$.none").isNotNull().alias("has_none"))


def q_date_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return _t(spark, d, "orders").select("o_orderkey", keys.us_date(text).cast("string").alias("parsed"))


def q_address_normalize(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.col("n_nationkey").cast("string"), F.lit(" north  main street, apt 4 "), F.col("n_name"))
    return _t(spark, d, "nation").select("n_nationkey", keys.address(raw).alias("address"), keys.street_base(raw).alias("street"))


def q_keyword_classify(spark: SparkSession, d: str) -> DataFrame:
    name = F.lower("p_name")
    kind = F.when(name.contains("bolt"), "fastener").when(name.contains("widget"), "widget").otherwise("other")
    return _t(spark, d, "part").groupBy(kind.alias("class")).agg(_n().alias("n"), F.array_join(F.sort_array(F.collect_set("p_type")), ", ").alias("types"))


def q_regex_class_counts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _t(spark, d, "pages").agg(F.count_if(u.rlike("^https://")).alias("n_secure"), F.count_if(u.rlike("[?&]utm_")).alias("n_tracked"), F.count_if(u.rlike("/[0-9]+")).alias("n_numbered"), F.count_if(~u.rlike("^https?://")).alias("n_other"))


def q_posexplode_ordinal(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("ordinal", "line"))
    return lines.select("doc_id", F.col("ordinal").cast("bigint").alias("ordinal"), F.length("line").cast("bigint").alias("chars"))


def q_fixed_width(spark: SparkSession, d: str) -> DataFrame:
    layout = [("n_nationkey", 6, "int"), ("n_name", 30, "string"), ("n_regionkey", 6, "int")]
    return fixed_width.parse(fixed_width.render(_t(spark, d, "nation"), layout), layout)


def q_pii_scan(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    count = lambda p: F.regexp_count(t, F.lit(p)).cast("bigint")
    return _t(spark, d, "documents").select("doc_id", count(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").alias("n_mail"), count(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b").alias("n_ssn"))


def q_incremental_available_now(spark: SparkSession, d: str) -> DataFrame:
    """Events appended by a stream, called twice: the second call adds nothing."""
    top = work_folder(spark, "events")
    source = f"{d}/events.parque[t]"
    load_new(spark, source, f"{top}/rows", f"{top}/state")
    return load_new(spark, source, f"{top}/rows", f"{top}/state").groupBy("event_type").agg(_n().alias("n"), F.countDistinct("event_id").alias("n_ids"))


ORACLE = {
    "q_group_by_expr_slug": "SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n, min(page_id) AS first_id, max(page_id) AS last_id FROM pages WHERE regexp_extract(url, '^https?://([^/]+)', 1) <> '' GROUP BY 1",
    "q_verification_row": "SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_buyers, (SELECT count(*) FROM orders WHERE o_totalprice <= 0) AS n_free, (SELECT count(*) FROM lineitem) AS n_lines, (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL) AS n_unshipped",
    "q_rows_and_folios": "SELECT 'orders' AS table_name, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_folios FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events",
    "q_tier_report": "SELECT CASE r WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS tier, count(*) AS n, count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM (SELECT user_id, event_type, max(CASE WHEN value >= 100 THEN 3 WHEN value >= 50 THEN 2 ELSE 1 END) AS r FROM events GROUP BY 1, 2) GROUP BY 1",
    "q_collision_counts": "SELECT 'parts_of_several_suppliers' AS measure, count(*) AS n FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1) UNION ALL SELECT 'suppliers_of_several_parts', count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1)",
    "q_histogram_topk": "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "q_running_stats": "SELECT lang, min(n_chars) AS least, max(n_chars) AS most, CAST(sum(n_chars) AS BIGINT) AS total, count(*) AS n FROM documents GROUP BY 1",
    "q_shard_index": f"SELECT c_custkey // {SHARD} AS shard, count(*) AS n, min(c_custkey) AS first_key, max(c_custkey) AS last_key FROM customer GROUP BY 1",
    "q_ordered_digest": f"SELECT item_id // {SHARD} AS shard, sha256(string_agg(item_id || '|' || sha256(coalesce(text, '')), chr(10) ORDER BY item_id)) AS digest FROM benchmark GROUP BY 1",
    "q_json_extract": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') IS NOT NULL AS has_k, json_extract_string(props, '$.none') IS NOT NULL AS has_none FROM events",
    "q_date_parse": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders",
    "q_address_normalize": "SELECT n_nationkey, n_nationkey || ' NORTH MAIN ST APT 4 ' || replace(upper(n_name), '_', ' ') AS address, n_nationkey || ' NORTH MAIN ST' AS street FROM nation",
    "q_keyword_classify": "SELECT CASE WHEN p_name ILIKE '%bolt%' THEN 'fastener' WHEN p_name ILIKE '%widget%' THEN 'widget' ELSE 'other' END AS class, count(*) AS n, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1",
    "q_regex_class_counts": "SELECT count(*) FILTER (WHERE url LIKE 'https://%') AS n_secure, count(*) FILTER (WHERE regexp_matches(url, '[?&]utm_')) AS n_tracked, count(*) FILTER (WHERE regexp_matches(url, '/[0-9]+')) AS n_numbered, count(*) FILTER (WHERE NOT regexp_matches(url, '^https?://')) AS n_other FROM pages",
    "q_posexplode_ordinal": "SELECT doc_id, i - 1 AS ordinal, length(parts[i]) AS chars FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))",
    "q_fixed_width": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "q_pii_scan": r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS n_mail, len(regexp_extract_all(coalesce(text, ''), '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b')) AS n_ssn FROM documents",
    "q_incremental_available_now": "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events GROUP BY 1",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
