"""Queries of the records engine on the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators.picks import first_per_key, merge_counters


def _t(spark: SparkSession, sf_dir: str, *names: str):
    found = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


def q_mart_star(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer: place, latest order, order totals."""
    c, n, r, o = _t(spark, d, "customer", "nation", "region", "orders")
    # One aggregation with partial results; a window would sort all orders of a customer.
    last = F.min_by(F.struct("o_orderkey", "o_orderstatus"), F.struct(-F.unix_micros(F.col("o_orderdate").cast("timestamp")), "o_orderkey"))
    sums = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("max_price"), last.alias("l"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
        .join(sums.withColumnRenamed("o_custkey", "k2"), F.col("c_custkey") == F.col("k2"), "left")
        .select("c_custkey", "n_name", "r_name", F.col("l.o_orderkey").alias("last_order"), F.col("l.o_orderstatus").alias("last_status"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "max_price", F.col("n_orders").isNotNull().alias("has_orders"))
    )


def q_first_per_key_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    return first_per_key(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


def q_last_write_wins(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    return e.groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))


def q_string_agg_distinct(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_set("o_orderpriority")), " | ").alias("priorities"))


def q_count_filter(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > 25).alias("n_large"), F.count_if(F.col("l_discount").isNull()).alias("n_no_discount"), F.count("*").alias("n"))


def q_coverage_minmax(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("ingested_count"), F.min("ts").alias("first_loaded_at"), F.max("ts").alias("last_loaded_at"))


def q_having_dups(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.groupBy(F.sha2("text", 256).alias("text_hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def q_existence_flag(spark: SparkSession, d: str) -> DataFrame:
    c, o = _t(spark, d, "customer", "orders")
    has = o.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has_orders", F.lit(True))
    return c.select("c_custkey").join(has, "c_custkey", "left").withColumn("has_orders", F.coalesce("has_orders", F.lit(False)))


def q_anti_join(spark: SparkSession, d: str) -> DataFrame:
    c, o = _t(spark, d, "customer", "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


def q_left_join_count(spark: SparkSession, d: str) -> DataFrame:
    c, o = _t(spark, d, "customer", "orders")
    n = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return c.select("c_custkey").join(n, "c_custkey", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def q_full_outer_intersections(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _t(spark, d, "documents", "labels")
    a = docs.select("doc_id").distinct().withColumn("a", F.lit(1))
    b = labels.select("doc_id").distinct().withColumn("b", F.lit(1))
    j = a.join(b, "doc_id", "full")
    return j.agg(F.count("*").alias("n_union"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n_both"), F.count_if(F.col("b").isNull()).alias("n_only_documents"), F.count_if(F.col("a").isNull()).alias("n_only_labels"))


def q_set_difference(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _t(spark, d, "documents", "labels")
    return docs.select("doc_id").subtract(labels.select("doc_id"))


def q_merge_counters(spark: SparkSession, d: str) -> DataFrame:
    """A copy of customer with a new key range and changed balances, staged against it."""
    c = _t(spark, d, "customer")
    hashed = lambda x: x.withColumn("h", F.sha2(F.concat_ws("|", "c_name", F.col("c_acctbal").cast("decimal(18,2)").cast("string")), 256))
    changed = c.withColumns({"c_acctbal": F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), "c_custkey": F.when(F.col("c_custkey") % 10 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))})
    return merge_counters(hashed(c), hashed(changed), "c_custkey", "h")


def q_safe_numeric(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


def q_unpivot(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "value")


_PICK = "row_number() OVER (PARTITION BY o_custkey ORDER BY {} DESC, o_orderkey) rn FROM orders"

ORACLE = {
    "q_mart_star": f"""SELECT c_custkey, n_name, r_name, l.o_orderkey AS last_order, l.o_orderstatus AS last_status, coalesce(s.n, 0) AS n_orders, s.m AS max_price, s.n IS NOT NULL AS has_orders
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT * FROM (SELECT *, {_PICK.format("o_orderdate")}) WHERE rn = 1) l ON l.o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey, count(*) n, max(o_totalprice) m FROM orders GROUP BY 1) s ON s.o_custkey = c_custkey""",
    "q_first_per_key_tiebreak": f"SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, {_PICK.format('o_totalprice')}) WHERE rn = 1",
    "q_last_write_wins": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "q_string_agg_distinct": "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
    "q_count_filter": "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS n_large, count(*) FILTER (WHERE l_discount IS NULL) AS n_no_discount, count(*) AS n FROM lineitem GROUP BY 1",
    "q_coverage_minmax": "SELECT event_type, count(*) AS ingested_count, min(ts) AS first_loaded_at, max(ts) AS last_loaded_at FROM events GROUP BY 1",
    "q_having_dups": "SELECT sha256(text) AS text_hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "q_existence_flag": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders FROM customer",
    "q_anti_join": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "q_left_join_count": "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "q_full_outer_intersections": """SELECT count(*) AS n_union, count(*) FILTER (WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL) AS n_both, count(*) FILTER (WHERE b.doc_id IS NULL) AS n_only_documents, count(*) FILTER (WHERE a.doc_id IS NULL) AS n_only_labels
        FROM (SELECT DISTINCT doc_id FROM documents) a FULL JOIN (SELECT DISTINCT doc_id FROM labels) b USING (doc_id)""",
    "q_set_difference": "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
    "q_merge_counters": """WITH stage AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS k, c_name, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS bal FROM customer)
        SELECT count(*) FILTER (WHERE t.c_custkey IS NULL) AS inserted, count(*) FILTER (WHERE t.c_custkey IS NOT NULL AND t.c_acctbal <> bal) AS updated, count(*) FILTER (WHERE t.c_acctbal = bal) AS unchanged
        FROM stage LEFT JOIN customer t ON t.c_custkey = k""",
    "q_safe_numeric": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "q_unpivot": "SELECT l_orderkey, l_linenumber, measure, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_discount, l_tax))",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
