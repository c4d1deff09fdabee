"""Merges, reference resolution, joins with a policy and checks on the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import checks, joins, merge

SPEC = merge.Spec(keys=("c_custkey",), guards=("row_hash", "nation_id"), keep_first=("first_seen",))


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _target(spark: SparkSession, d: str) -> DataFrame:
    """Two thirds of the customers as loaded; every fifth one without a resolved nation."""
    c = _t(spark, d, "customer").where("c_custkey % 3 <> 0")
    return c.select("c_custkey", F.col("c_mktsegment").alias("row_hash"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("nation_id"), F.when(F.col("c_custkey") % 2 == 0, "r1").alias("first_seen"))


def _stage(spark: SparkSession, d: str) -> DataFrame:
    """Staged customers, some twice with another segment, and their nations by name."""
    c = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.when(F.col("c_custkey") % 11 == 0, F.lit("gone:x")).when(F.col("c_custkey") % 13 == 0, F.col("n_name")).otherwise(F.concat(F.lit("iso:"), F.col("n_name")))
    once = c.where("c_custkey % 4 <> 0").select("c_custkey", F.col("c_mktsegment").alias("row_hash"), key.alias("nation_key"), F.lit("r2").alias("first_seen"), F.col("c_custkey").alias("row_index"))
    again = once.where("c_custkey % 7 = 0").withColumns({"row_hash": F.lower("row_hash"), "row_index": F.col("row_index") + 1000000000})
    return once.unionByName(again)


def _nations(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    keyed = lambda system, key: n.select(F.col("n_nationkey").alias("nation_id"), "n_regionkey", key.alias("source_record_key"), F.lit(system).alias("source_system"))
    return keyed("iso", F.concat(F.lit("iso:"), F.col("n_name"))).unionByName(keyed("old", F.col("n_name")))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return merge.resolve(_stage(spark, d), merge.Reference("nation_key", _nations(spark, d), "nation_id", "nation_id"))


def q_bulk_merge(spark: SparkSession, d: str) -> DataFrame:
    """References resolved, the last staged row of a key taken, rows inserted or updated where hash or reference differ."""
    return merge.merge(_target(spark, d), _resolved(spark, d), SPEC).select("c_custkey", "row_hash", F.col("nation_id").cast("string").alias("nation_id"), "first_seen", "change")


def q_merge_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a merge and of the same merge once more over its result: the second changes nothing."""
    stage = _resolved(spark, d)
    one = merge.merge(_target(spark, d), stage, SPEC)
    two = merge.merge(one.drop("change"), stage, SPEC)
    return merge.counters(stage, one, SPEC).withColumn("run", F.lit(1)).unionByName(merge.counters(stage, two, SPEC).withColumn("run", F.lit(2)))


def q_fk_alternatives(spark: SparkSession, d: str) -> DataFrame:
    """A reference by key, else by name alone; the region filled from the parent where the stage has none."""
    s = _t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lit("none:x")).otherwise(F.concat(F.lit("iso:"), F.col("c_nationkey").cast("string"))).alias("by_key"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey")).alias("by_id"), F.when(F.col("c_custkey") % 5 == 0, F.lit("own")).otherwise("").alias("region"))
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nation_id"), "n_nationkey", F.concat(F.lit("iso:"), F.col("n_nationkey").cast("string")).alias("source_record_key"), F.lit("iso").alias("source_system"), F.col("n_regionkey").cast("string").alias("region_of"))
    first = merge.Reference("by_key", n, "nation_id", "nation_id", hydrate={"region_of": "region"})
    second = merge.Reference("by_id", n, "nation_id", "nation_id", parent_key="n_nationkey", parent_system=None)
    return merge.resolve(s, first, second).select("c_custkey", F.col("nation_id").cast("string").alias("nation_id"), "region")


def q_coverage_policies(spark: SparkSession, d: str) -> DataFrame:
    """Coverage rows: counts and last day are replaced, the first day stays the earliest known, a known id stays."""
    o = _t(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    made = lambda rows, cid: rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")).withColumn("cid", cid)
    known = made(o.where("o_orderkey % 2 = 0 and o_orderpriority < '4'"), F.when(F.col("o_orderpriority") < "2", "known"))
    new = made(o.where("o_orderkey % 3 = 0 and o_orderpriority > '1-V'"), F.lit("new")).withColumn("row_index", F.lit(1))
    spec = merge.Spec(keys=("o_orderpriority",), guards=("n", "last_day"), keep_first=("cid",), earliest=("first_day",))
    return merge.merge(known, new, spec)


def q_scope_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Sources staged whole: stale rows of a staged source go, rows of other sources stay."""
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 0).cast("bigint").cast("string").alias("v"))
    target = c.where("c_custkey % 2 = 0")
    stage = c.where("c_mktsegment in ('BUILDING', 'MACHINERY') and c_custkey % 3 = 0").withColumn("row_index", F.lit(1))
    return merge.refresh_scope(target, stage, "c_mktsegment", merge.Spec(keys=("c_custkey",), guards=("v", "c_mktsegment")))


def q_source_delete(spark: SparkSession, d: str) -> DataFrame:
    return merge.delete_source(_t(spark, d, "customer"), "c_mktsegment", "BUILDING", "FURNITURE").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def q_release_history(spark: SparkSession, d: str) -> DataFrame:
    """Three releases of parts: first and last release seen, and whether the part is in the last one."""
    p = _t(spark, d, "part").select("p_partkey", F.col("p_brand").alias("hash"))
    none = spark.createDataFrame([], "p_partkey bigint, hash string, first_seen string, last_seen string, is_current boolean")
    out = none
    for name, rows in (("r1", p.where("p_partkey % 2 = 0")), ("r2", p.where("p_partkey % 3 = 0")), ("r3", p.where("p_partkey % 4 = 0").withColumn("hash", F.lower("hash")))):
        out = merge.release(out, rows, "p_partkey", name)
    return out


def q_either_key(spark: SparkSession, d: str) -> DataFrame:
    """Orders met by customer or by order number, each pair once."""
    o, e = _t(spark, d, "orders").select("o_orderkey", "o_custkey"), _t(spark, d, "events").select("event_id", "user_id")
    return joins.either_key(e, o, [("user_id", "o_custkey"), ("event_id", "o_orderkey")], "event_id", "o_orderkey").groupBy("event_id").agg(F.count("*").alias("n_orders"))


def q_update_linked(spark: SparkSession, d: str) -> DataFrame:
    """Events get the first order of either key where they have none or another one; whether that changed them."""
    o, e = _t(spark, d, "orders").select("o_orderkey", "o_custkey"), _t(spark, d, "events").select("event_id", "user_id")
    link = joins.either_key(e, o, [("user_id", "o_custkey"), ("event_id", "o_orderkey")], "event_id", "o_orderkey").groupBy("event_id").agg(F.min("o_orderkey").alias("found"))
    old = F.when(F.col("event_id") % 2 == 0, F.col("event_id"))
    new = F.coalesce("found", old)
    return e.join(link, "event_id", "left").select("event_id", new.cast("string").alias("order_id"), (~new.eqNullSafe(old)).alias("changed"))


def q_delete_unexpected(spark: SparkSession, d: str) -> DataFrame:
    """Stored child rows whose value does not stand at their place in the parent's list."""
    parents = _t(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("words"))
    stored = parents.select("p_partkey", F.posexplode("words").alias("ordinal", "value")).withColumn("value", F.when(F.col("p_partkey") % 7 == 0, F.lit("OLD")).otherwise(F.col("value")))
    return joins.without_expected(stored, parents, "p_partkey", "words")


def q_strict_join(spark: SparkSession, d: str) -> DataFrame:
    """Three files that must hold each key once: duplicates, missing and total keys of each."""
    c = _t(spark, d, "customer").select("c_custkey")
    parts = {"master": c, "agent": c.where("c_custkey % 10 <> 0"), "name": c.where("c_custkey % 4 <> 0").unionAll(c.where("c_custkey % 100 = 1"))}
    return joins.strict(parts, "c_custkey")[1]


def q_strict_joined(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    parts = {"master": c.select("c_custkey", "c_name"), "agent": c.where("c_custkey % 10 <> 0").select("c_custkey", "c_mktsegment"), "name": c.select("c_custkey", "c_nationkey").unionAll(c.where("c_custkey % 100 = 1").select("c_custkey", "c_nationkey"))}
    return joins.strict(parts, "c_custkey")[0]


def q_three_way_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Keys in customers, ordering customers and event users by combination of the three."""
    parts = {"customer": _t(spark, d, "customer").select(F.col("c_custkey").alias("k")), "orders": _t(spark, d, "orders").select(F.col("o_custkey").alias("k")), "events": _t(spark, d, "events").select(F.col("user_id").alias("k"))}
    return joins.overlap(parts, "k")


def q_matched_ids(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers with the sorted customers of the same nation and thousand of balance, found by a hash of both."""
    key = lambda n, b: F.sha2(F.concat_ws("|", n, F.round(b / 1000, 0).cast("int")), 256)
    s = _t(spark, d, "supplier").select("s_suppkey", key(F.col("s_nationkey"), F.col("s_acctbal")).alias("h"))
    c = _t(spark, d, "customer").select("c_custkey", key(F.col("c_nationkey"), F.col("c_acctbal")).alias("h"))
    return joins.matched_ids(s, c, "h", "s_suppkey", "c_custkey").select("s_suppkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


def q_scope_expansion(spark: SparkSession, d: str) -> DataFrame:
    """All lines of the orders that have a line of a wanted part."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return joins.expand_scope(li, _t(spark, d, "part").where("p_size = 7").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "l_orderkey")


def q_checks(spark: SparkSession, d: str) -> DataFrame:
    """A gate's report: unique keys, counts, orphans, patterns, duplicates, equal tables, unchanged counts."""
    o, c, li, p = (_t(spark, d, x) for x in ("orders", "customer", "lineitem", "part"))
    n = lambda df: df.groupBy(F.col("o_orderstatus").alias("table")).agg(F.count("*").alias("n"))
    return checks.report(
        checks.unique(o, "orders", "o_orderkey"),
        checks.unique(o.withColumn("k", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))), "customers of orders", "k"),
        checks.same_count(o, li, "orders with lines", None),
        checks.orphans(o, c, "orders without customer", "o_custkey", "c_custkey"),
        checks.orphans(li, p.where("p_size < 25"), "lines without small part", "l_partkey", "p_partkey"),
        checks.none(p, "brands without number", ~F.col("p_brand").rlike("^Brand#[0-9]+$")),
        checks.at_least(p, "parts of size 1", 1, F.col("p_size") == 1),
        checks.duplicates(li, "lines with one key", "l_orderkey", "l_linenumber"),
        checks.equal_tables(c.select("c_custkey"), c.where("c_custkey <> 2").select("c_custkey"), "customers but one"),
        checks.unchanged(n(o), n(o.where("o_orderkey % 2 = 0 or o_orderstatus = 'F'")), "status counts"),
    ).select("rule", "expected", "actual", "ok")


_STAGE = """c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
once AS (SELECT c_custkey, c_mktsegment AS row_hash, CASE WHEN c_custkey % 11 = 0 THEN 'gone:x' WHEN c_custkey % 13 = 0 THEN n_name ELSE 'iso:' || n_name END AS nation_key, c_custkey AS row_index FROM c WHERE c_custkey % 4 <> 0),
stage AS (SELECT * FROM once UNION ALL SELECT c_custkey, lower(row_hash), nation_key, row_index + 1000000000 FROM once WHERE c_custkey % 7 = 0),
s AS (SELECT DISTINCT ON (c_custkey) c_custkey, row_hash, n_nationkey AS nation_id FROM stage LEFT JOIN nation ON nation_key IN (n_name, 'iso:' || n_name) ORDER BY c_custkey, row_index DESC),
t AS (SELECT c_custkey, c_mktsegment AS row_hash, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nation_id, CASE WHEN c_custkey % 2 = 0 THEN 'r1' END AS first_seen FROM customer WHERE c_custkey % 3 <> 0),
m AS (SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.row_hash AS th, s.row_hash AS sh, t.nation_id AS tn, s.nation_id AS sn, t.first_seen AS f,
  CASE WHEN t.c_custkey IS NULL THEN 'inserted' WHEN s.c_custkey IS NULL THEN 'absent' WHEN t.row_hash IS DISTINCT FROM s.row_hash OR t.nation_id IS DISTINCT FROM s.nation_id THEN 'updated' ELSE 'unchanged' END AS change
  FROM t FULL JOIN s ON t.c_custkey = s.c_custkey)"""

ORACLE = {
    "q_bulk_merge": f"WITH {_STAGE} SELECT c_custkey, CASE WHEN change = 'absent' THEN th ELSE sh END AS row_hash, CAST(CASE WHEN change = 'absent' THEN tn ELSE sn END AS VARCHAR) AS nation_id, CASE WHEN change IN ('inserted', 'updated') THEN coalesce(f, 'r2') ELSE f END AS first_seen, change FROM m",
    "q_merge_rerun": f"WITH {_STAGE}, n AS (SELECT count(*) FILTER (change <> 'absent') AS deduped, count(*) FILTER (change IN ('inserted', 'updated')) AS changed FROM m) SELECT (SELECT count(*) FROM stage) AS attempted, deduped, CASE run WHEN 1 THEN changed ELSE 0 END AS changed, CASE run WHEN 1 THEN deduped - changed ELSE deduped END AS unchanged, CAST(run AS INTEGER) AS run FROM n, (VALUES (1), (2)) AS r(run)",
    "q_fk_alternatives": "SELECT c_custkey, CAST(coalesce(a.n_nationkey, b.n_nationkey) AS VARCHAR) AS nation_id, CASE WHEN c_custkey % 5 = 0 THEN 'own' ELSE CAST(a.n_regionkey AS VARCHAR) END AS region FROM customer LEFT JOIN nation a ON c_custkey % 2 <> 0 AND a.n_nationkey = c_nationkey LEFT JOIN nation b ON c_custkey % 3 = 0 AND b.n_nationkey = c_nationkey",
    "q_coverage_policies": """WITH o AS (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders),
t AS (SELECT o_orderpriority AS k, count(*) AS n, min(day) AS a, max(day) AS z, CASE WHEN o_orderpriority < '2' THEN 'known' END AS cid FROM o WHERE o_orderkey % 2 = 0 AND o_orderpriority < '4' GROUP BY 1),
s AS (SELECT o_orderpriority AS k, count(*) AS n, min(day) AS a, max(day) AS z FROM o WHERE o_orderkey % 3 = 0 AND o_orderpriority > '1-V' GROUP BY 1)
SELECT k AS o_orderpriority, coalesce(s.n, t.n) AS n, least(s.a, t.a) AS first_day, coalesce(s.z, t.z) AS last_day, CASE WHEN s.k IS NULL THEN cid ELSE coalesce(cid, 'new') END AS cid,
CASE WHEN t.k IS NULL THEN 'inserted' WHEN s.k IS NULL THEN 'absent' WHEN s.n <> t.n OR s.z <> t.z THEN 'updated' ELSE 'unchanged' END AS change FROM t FULL JOIN s USING (k)""",
    "q_scope_refresh": """WITH c AS (SELECT c_custkey, c_mktsegment, CAST(CAST(round(c_acctbal, 0) AS BIGINT) AS VARCHAR) AS v FROM customer)
SELECT *, CASE WHEN c_custkey % 2 = 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 = 0 THEN 'unchanged' WHEN c_custkey % 2 = 0 THEN 'absent' ELSE 'inserted' END AS change
FROM c WHERE (c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 = 0) OR (c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_custkey % 2 = 0)""",
    "q_source_delete": "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING', 'FURNITURE') GROUP BY 1",
    "q_release_history": """WITH p AS (SELECT p_partkey, p_brand, p_partkey % 2 = 0 AS a, p_partkey % 3 = 0 AS b, p_partkey % 4 = 0 AS c FROM part)
SELECT p_partkey, CASE WHEN c THEN lower(p_brand) ELSE p_brand END AS hash, CASE WHEN a THEN 'r1' WHEN b THEN 'r2' ELSE 'r3' END AS first_seen, CASE WHEN c THEN 'r3' WHEN b THEN 'r2' ELSE 'r1' END AS last_seen, c AS is_current FROM p WHERE a OR b OR c""",
    "q_either_key": "SELECT event_id, count(*) AS n_orders FROM (SELECT event_id, o_orderkey FROM events JOIN orders ON user_id = o_custkey UNION SELECT event_id, o_orderkey FROM events JOIN orders ON event_id = o_orderkey) GROUP BY 1",
    "q_update_linked": """WITH l AS (SELECT event_id, min(o_orderkey) AS found FROM (SELECT event_id, o_orderkey FROM events JOIN orders ON user_id = o_custkey UNION ALL SELECT event_id, o_orderkey FROM events JOIN orders ON event_id = o_orderkey) GROUP BY 1),
e AS (SELECT event_id, found, CASE WHEN event_id % 2 = 0 THEN event_id END AS old FROM events LEFT JOIN l USING (event_id))
SELECT event_id, CAST(coalesce(found, old) AS VARCHAR) AS order_id, coalesce(found, old) IS DISTINCT FROM old AS changed FROM e""",
    "q_delete_unexpected": "SELECT p_partkey, CAST(unnest(range(0, len(string_split(p_type, ' ')))) AS INTEGER) AS ordinal, 'OLD' AS value FROM part WHERE p_partkey % 7 = 0",
    "q_strict_join": """WITH p AS (SELECT 'master' AS part, c_custkey AS k, 1 AS n FROM customer UNION ALL SELECT 'agent', c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN 1 ELSE 0 END FROM customer
UNION ALL SELECT 'name', c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 100 = 1 THEN 1 ELSE 0 END FROM customer)
SELECT part, count(*) FILTER (n > 1) AS duplicates, count(*) FILTER (n = 0) AS missing, count(*) AS keys FROM p GROUP BY 1""",
    "q_strict_joined": "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 100 <> 1",
    "q_three_way_overlap": """WITH k AS (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders UNION SELECT user_id FROM events)
SELECT in_customer, in_orders, in_events, count(*) AS n_keys FROM (SELECT k IN (SELECT c_custkey FROM customer) AS in_customer, k IN (SELECT o_custkey FROM orders) AS in_orders, k IN (SELECT user_id FROM events) AS in_events FROM k WHERE k IS NOT NULL) GROUP BY 1, 2, 3""",
    "q_matched_ids": "SELECT s_suppkey, coalesce(string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey), '') AS ids FROM supplier LEFT JOIN customer ON s_nationkey = c_nationkey AND round(s_acctbal / 1000, 0) = round(c_acctbal / 1000, 0) GROUP BY 1",
    "q_scope_expansion": "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7)",
    "q_checks": r"""WITH r AS (
SELECT 'orders: rows' AS rule, count(DISTINCT o_orderkey) AS expected, count(*) AS actual FROM orders
UNION ALL SELECT 'orders: without key', 0, count(*) FILTER (o_orderkey IS NULL) FROM orders
UNION ALL SELECT 'customers of orders: rows', count(DISTINCT CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END) + count(*) FILTER (o_orderkey % 5 = 0), count(*) FROM orders
UNION ALL SELECT 'customers of orders: without key', 0, count(*) FILTER (o_orderkey % 5 = 0) FROM orders
UNION ALL SELECT 'orders with lines', (SELECT count(*) FROM orders), count(*) FROM lineitem
UNION ALL SELECT 'orders without customer', 0, count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lines without small part', 0, count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)
UNION ALL SELECT 'brands without number', 0, count(*) FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]+$')
UNION ALL SELECT 'parts of size 1', 1, count(*) FROM part WHERE p_size = 1
UNION ALL SELECT 'lines with one key', 0, count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'customers but one', 0, count(*) FROM customer WHERE c_custkey = 2
UNION ALL SELECT 'status counts', 0, count(*) FROM (SELECT o_orderstatus FROM orders GROUP BY 1 HAVING o_orderstatus <> 'F' AND count(*) FILTER (o_orderkey % 2 <> 0) > 0))
SELECT rule, CAST(expected AS BIGINT) AS expected, actual, CASE rule WHEN 'parts of size 1' THEN actual >= 1 ELSE expected = actual END AS ok FROM r""",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
