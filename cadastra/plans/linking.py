"""Joins, merges, guards and rankings on the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import keys


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def q_folio_count(spark: SparkSession, d: str) -> DataFrame:
    """Distinct folios per class; a row without a parent counts by its own negated key."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer").where("c_acctbal > 0")
    folio = F.coalesce("c_custkey", -F.col("o_custkey") - 1)
    return o.join(c, o.o_custkey == c.c_custkey, "left").groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"), F.countDistinct(folio).alias("n_folios"))


def q_computed_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders met through the digits of the customer's name."""
    c = _t(spark, d, "customer").select("c_custkey", keys.digits(F.col("c_name")).try_cast("bigint").alias("k"))
    n = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    return c.join(n, "k").select("c_custkey", "n_orders")


def q_name_key_join(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part").select("p_partkey", keys.name_key(F.col("p_name")).alias("name_key"))
    seen = p.groupBy("name_key").agg(F.count("*").alias("n_same"), F.min("p_partkey").alias("first_key"))
    return p.join(seen, "name_key").select("p_partkey", "name_key", "n_same", "first_key")


def q_fk_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Staged references: a known one becomes the key, an unknown one null and is flagged."""
    e, c = _t(spark, d, "events"), _t(spark, d, "customer").select("c_custkey")
    return e.join(c, e.user_id == c.c_custkey, "left").select("event_id", "c_custkey", F.col("c_custkey").isNull().alias("dangling"))


def _lines_of_parts(li: DataFrame, p: DataFrame) -> DataFrame:
    rows = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    by_part = rows.join(p, rows.l_partkey == p.p_partkey)
    by_supplier = rows.join(p, rows.l_suppkey == p.p_partkey).where("l_partkey <> l_suppkey")
    return by_part.unionAll(by_supplier).groupBy("p_partkey").agg(F.count("*").alias("n_lines"))


def q_or_join_union(spark: SparkSession, d: str) -> DataFrame:
    """A join on either of two keys as the union of two equi-joins, each pair once."""
    return _lines_of_parts(_t(spark, d, "lineitem"), _t(spark, d, "part").where("p_size <= 10").select("p_partkey"))


def q_or_join_whole(spark: SparkSession, d: str) -> DataFrame:
    """The same join over all parts."""
    return _lines_of_parts(_t(spark, d, "lineitem"), _t(spark, d, "part").select("p_partkey"))


def q_exists_flag_or(spark: SparkSession, d: str) -> DataFrame:
    """Customers with an urgent order or a returned line."""
    o = _t(spark, d, "orders")
    urgent = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    back = _t(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    returned = o.join(back, o.o_orderkey == back.l_orderkey).select(F.col("o_custkey").alias("c_custkey"))
    flagged = urgent.union(returned).distinct().withColumn("flag", F.lit(True))
    return _t(spark, d, "customer").select("c_custkey").join(flagged, "c_custkey", "left").withColumn("flag", F.coalesce("flag", F.lit(False)))


def q_row_distinct_guard(spark: SparkSession, d: str) -> DataFrame:
    """Rows that an update would change, nulls compared as values."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    price = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    staged = o.select("o_orderkey", status.alias("s"), price.alias("p"))
    changed = ~(F.col("o_orderstatus").eqNullSafe(F.col("s")) & F.col("o_totalprice").eqNullSafe(F.col("p")))
    return o.join(staged, "o_orderkey").where(changed).select("o_orderkey", "s", "p")


def q_upsert_policy(spark: SparkSession, d: str) -> DataFrame:
    """A later batch over an earlier one: the latest value wins, a missing one keeps the old, first_seen never grows."""
    e = _t(spark, d, "events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    batch = lambda late: e.where((F.col("event_id") % 2 == 1) == late).groupBy("user_id").agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.col("event_id"))).alias("v"), F.min("event_id").alias("first"))
    old, new = batch(False).toDF("user_id", "ov", "of"), batch(True).toDF("user_id", "nv", "nf")
    return old.join(new, "user_id", "full").select("user_id", F.coalesce("nv", "ov").alias("value"), F.least("of", "nf").alias("first_seen"))


def q_candidate_rank(spark: SparkSession, d: str) -> DataFrame:
    """The best 25 customers by five keys, with their position."""
    o = _t(spark, d, "orders")
    s = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"), F.count_distinct("o_orderstatus").alias("n_status"), F.max("o_totalprice").alias("top"))
    best = s.orderBy(F.desc("n_urgent"), F.desc("n"), F.desc("n_status"), F.desc("top"), "o_custkey").limit(25)
    listed = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("n_urgent")).alias("a"), (-F.col("n")).alias("b"), (-F.col("n_status")).alias("c"), (-F.col("top")).alias("d"), "o_custkey"))).alias("x"))
    return listed.select(F.posexplode("x").alias("i", "r")).select((F.col("i") + 1).cast("bigint").alias("rank"), F.col("r.o_custkey").alias("c_custkey"), (-F.col("r.b")).alias("n_orders"), (-F.col("r.a")).alias("n_urgent"))


def q_greedy_limit(spark: SparkSession, d: str) -> DataFrame:
    """Accept the first 100 fitting rows in key order; rows skipped are counted up to the last accepted.

    The broadcast side is one aggregate row.
    """
    o = _t(spark, d, "orders")
    taken = o.where("o_totalprice > 100000").orderBy("o_orderkey").limit(100).agg(F.count("*").alias("accepted"), F.max("o_orderkey").alias("last_key"))
    return o.join(F.broadcast(taken), F.col("o_orderkey") <= F.col("last_key")).groupBy("accepted", "last_key").agg(F.count_if(F.col("o_totalprice") <= 100000).alias("skipped"))


def q_scope_semi(spark: SparkSession, d: str) -> DataFrame:
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders").where("o_orderstatus = 'F'")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left_semi").groupBy("l_linestatus").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


def q_nested_doc(spark: SparkSession, d: str) -> DataFrame:
    """A document per customer: its orders in key order, each with its line numbers."""
    lines = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.concat_ws("/", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")))).alias("lines"))
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey", "left")
    docs = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.coalesce("lines", F.array().cast("array<string>")).alias("lines")))).alias("orders"))
    shown = F.array_join(F.transform("orders", lambda x: F.concat(x["o_orderkey"].cast("string"), F.lit(":"), F.array_join(x["lines"], ","))), ";")
    return _t(spark, d, "customer").select("c_custkey").join(docs, "c_custkey", "left").select("c_custkey", F.coalesce(F.size("orders").cast("bigint"), F.lit(0)).alias("n_orders"), F.coalesce(shown, F.lit("")).alias("orders"))


def q_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id").union(_t(spark, d, "labels").select("doc_id")).distinct()


_BATCH = "SELECT user_id, arg_max(CASE WHEN event_type <> 'error' THEN value END, event_id) FILTER (WHERE event_type <> 'error') AS v, min(event_id) AS f FROM events WHERE event_id % 2 = {} GROUP BY 1"

ORACLE = {
    "q_folio_count": "SELECT o_orderpriority, count(*) AS n_rows, count(DISTINCT coalesce(c_custkey, -o_custkey - 1)) AS n_folios FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey GROUP BY 1",
    "q_computed_key_join": "SELECT c_custkey, count(*) AS n_orders FROM customer JOIN orders ON o_custkey = TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) GROUP BY 1",
    "q_name_key_join": "SELECT p_partkey, k AS name_key, count(*) OVER (PARTITION BY k) AS n_same, min(p_partkey) OVER (PARTITION BY k) AS first_key FROM (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')) AS k FROM part)",
    "q_fk_resolve": "SELECT event_id, c_custkey, c_custkey IS NULL AS dangling FROM events LEFT JOIN customer ON user_id = c_custkey",
    "q_or_join_union": "SELECT p_partkey, count(*) AS n_lines FROM lineitem JOIN part ON l_partkey = p_partkey OR l_suppkey = p_partkey WHERE p_size <= 10 GROUP BY 1",
    "q_or_join_whole": "SELECT p_partkey, count(*) AS n_lines FROM lineitem JOIN part ON l_partkey = p_partkey OR l_suppkey = p_partkey GROUP BY 1",
    "q_exists_flag_or": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') OR EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_returnflag = 'R') AS flag FROM customer",
    "q_row_distinct_guard": "SELECT o_orderkey, s, p FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders) WHERE o_orderstatus IS DISTINCT FROM s OR o_totalprice IS DISTINCT FROM p",
    "q_upsert_policy": f"SELECT user_id, coalesce(n.v, o.v) AS value, least(o.f, n.f) AS first_seen FROM ({_BATCH.format(0)}) o FULL JOIN ({_BATCH.format(1)}) n USING (user_id)",
    "q_candidate_rank": "SELECT row_number() OVER (ORDER BY u DESC, n DESC, s DESC, t DESC, o_custkey) AS rank, o_custkey AS c_custkey, n AS n_orders, u AS n_urgent FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u, count(DISTINCT o_orderstatus) AS s, max(o_totalprice) AS t FROM orders GROUP BY 1) ORDER BY 1 LIMIT 25",
    "q_greedy_limit": "WITH a AS (SELECT *, sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey) AS upto FROM orders), l AS (SELECT max(o_orderkey) AS k FROM a WHERE o_totalprice > 100000 AND upto <= 100) SELECT count(*) FILTER (WHERE o_totalprice > 100000) AS accepted, max(o_orderkey) AS last_key, count(*) FILTER (WHERE o_totalprice <= 100000) AS skipped FROM a, l WHERE o_orderkey <= k",
    "q_scope_semi": "SELECT l_linestatus, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1",
    "q_nested_doc": "WITH l AS (SELECT l_orderkey, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT l_orderkey, l_linenumber || '/' || l_partkey || '/' || l_suppkey AS x FROM lineitem) GROUP BY 1) SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(string_agg(o_orderkey || ':' || coalesce(x, ''), ';' ORDER BY o_orderkey), '') AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1",
    "q_union_distinct": "SELECT doc_id FROM documents UNION SELECT doc_id FROM labels",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
