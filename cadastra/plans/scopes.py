"""Filters, groups, picks, samples, orders and geometry on the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import permits, scores
from cadastra.operators import geometry, joins, selection
from cadastra.plans.artifacts import work_folder
from cadastra.sinks import documents


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def q_prefix_scope(spark: SparkSession, d: str) -> DataFrame:
    """Sources that begin with a prefix and an underscore, as a literal prefix that reaches the scan."""
    s = _t(spark, d, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "src1_").otherwise("src1"), F.col("source")).alias("s"))
    return s.where(F.col("s").startswith("src1_")).groupBy("s").agg(F.count("*").alias("n"))


def q_any_of_list(spark: SparkSession, d: str) -> DataFrame:
    """Membership in a short list, in no list, and in a table."""
    c = _t(spark, d, "customer")
    few = c.where(joins.in_scope(F.col("c_nationkey"), [1, 5, 7])).agg(F.count("*").alias("n"))
    every = c.where(joins.in_scope(F.col("c_nationkey"), None)).agg(F.count("*").alias("n"))
    nothing = c.where(joins.in_scope(F.col("c_nationkey"), [])).agg(F.count("*").alias("n"))
    ordered = c.join(_t(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").agg(F.count("*").alias("n"))
    named = lambda df, name: df.withColumn("scope", F.lit(name))
    return named(few, "few").unionByName(named(every, "all")).unionByName(named(nothing, "none")).unionByName(named(ordered, "ordered"))


def q_like_any(spark: SparkSession, d: str) -> DataFrame:
    """Patterns without case over three columns, one excluded."""
    p, wanted = _t(spark, d, "part"), ["%BRASS%", "%#13", "steel%"]
    any_of = [F.col(c).ilike(w) for c in ("p_type", "p_brand", "p_name") for w in wanted]
    met = any_of[0]
    for c in any_of[1:]:
        met = met | c
    return p.where(met & ~F.col("p_type").ilike("%small%") & (F.col("p_size") != 3)).select("p_partkey")


def q_json_contains(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose JSON holds a key with a value, and the kind of that value."""
    e = _t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.schema_of_variant(F.try_parse_json("props")).alias("shape"))
    return e.where("k in ('5', '7')").select("event_id", "k", (F.col("shape") == "OBJECT<k: BIGINT>").alias("is_object"))


def q_exclusion_list(spark: SparkSession, d: str) -> DataFrame:
    """Rows outside a list that is a table; an empty list excludes nothing."""
    c, big = _t(spark, d, "customer"), _t(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    out = c.join(big, "c_nationkey", "left_anti").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return out.withColumn("list", F.lit("table")).unionByName(c.join(big.limit(0), "c_nationkey", "left_anti").groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("list", F.lit("empty")))


def q_joined_or_null(spark: SparkSession, d: str) -> DataFrame:
    """Fields joined by blanks, null where nothing is left."""
    p = _t(spark, d, "part")
    blank = lambda c, k: F.when(F.col("p_partkey") % k != 0, F.col(c))
    return p.select("p_partkey", F.nullif(F.trim(F.concat_ws(" ", blank("p_brand", 2), blank("p_type", 3))), F.lit("")).alias("line"))


def q_public_columns(spark: SparkSession, d: str) -> DataFrame:
    """An allow-list of columns; private ones come as null, false and 0."""
    c = _t(spark, d, "customer")
    return c.select("c_custkey", "c_mktsegment", F.lit(None).cast("string").alias("c_name"), F.lit(False).alias("has_owner"), F.lit(0).cast("bigint").alias("owner_count"))


def q_optional_filter(spark: SparkSession, d: str) -> DataFrame:
    """A filter that a parameter switches off is left out of the plan."""
    p = _t(spark, d, "part")
    counted = lambda everything: (p if everything else p.where("p_size > 40")).agg(F.count("*").alias("n")).withColumn("everything", F.lit(everything))
    return counted(True).unionByName(counted(False))


def q_view_columns(spark: SparkSession, d: str) -> DataFrame:
    """A view that takes a joined value and, without it, the row's own, over three left joins."""
    o, c, n, e = _t(spark, d, "orders"), _t(spark, d, "customer").where("c_custkey % 2 = 0"), _t(spark, d, "nation").where("n_nationkey < 12"), _t(spark, d, "events").select("event_id", "event_type")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(e, F.col("o_orderkey") == F.col("event_id"), "left")
    return j.select("o_orderkey", F.coalesce("n_name", "c_mktsegment", "o_orderpriority").alias("place"), F.coalesce("event_type", "o_orderstatus").alias("kind"))


def q_measure_row(spark: SparkSession, d: str) -> DataFrame:
    """Independent measures of several tables in one row; each table is read once."""
    o = _t(spark, d, "orders").agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.count_if(F.col("o_totalprice") > 100000).alias("large"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    li = _t(spark, d, "lineitem").agg(F.count("*").alias("lines"), F.countDistinct("l_partkey").alias("parts"), F.count_if(F.col("l_discount") > 0.05).alias("cheap"))
    lost = _t(spark, d, "part").join(_t(spark, d, "lineitem"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").agg(F.count("*").alias("unsold"))
    return o.join(li).join(lost)


def q_candidate_groups(spark: SparkSession, d: str) -> DataFrame:
    """Per customer: sums, flags, distinct priorities, the first eight orders and the score of a candidate."""
    o = _t(spark, d, "orders")
    n = lambda c: F.count_if(c)
    sums = o.groupBy("o_custkey").agg(
        F.count("*").alias("permits"), n(F.col("o_orderstatus") == "F").alias("commercial"), n(F.col("o_orderstatus") != "P").alias("live"), n(F.col("o_totalprice") > 200000).alias("inspections"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("kinds")
    )
    few = selection.first_samples(o, "o_custkey", ["o_orderkey"], "o_orderkey", 8)
    zero = F.lit(0)
    score = permits.candidate_score({"commercial": F.col("commercial"), "live": F.col("live"), "inspections": F.col("inspections"), "contacts": zero, "documents": zero, "links": F.col("permits"), "registrations": zero, "address_permits": zero})
    return sums.join(few, "o_custkey").select("o_custkey", "permits", "kinds", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"), score.alias("score"))


def q_keyword_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per brand: rows with a keyword of industrial use in a made-up text and the sorted keywords met."""
    p = _t(spark, d, "part")
    text = F.concat(F.when(F.col("p_partkey") % 3 == 0, "new Warehouse for ").otherwise("sign at "), F.when(F.col("p_partkey") % 5 == 0, "cold  storage").when(F.col("p_partkey") % 7 == 0, "FACTORY").otherwise("shop"))
    met = p.select("p_brand", permits.industrial_keywords(text).alias("k")).where(F.size("k") > 0)
    return met.groupBy("p_brand").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("k")))), "|").alias("keywords"))


def q_file_classes(spark: SparkSession, d: str) -> DataFrame:
    """File names by class, fourteen patterns in one pass."""
    names = ("address", "building", "deed", "file", "flood", "geometry", "layout", "lot", "ownership", "parcel", "person", "sales", "structure", "tax")
    e = _t(spark, d, "events").select(F.concat(F.lit("data/"), F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("event_id") % 14 + 1).cast("int")), F.when(F.col("event_id") % 3 == 0, "").otherwise("_1"), F.when(F.col("event_id") % 10 == 0, ".txt").otherwise(".json")).alias("name"))
    return selection.class_counts(e, "name", {x: rf"^data/{x}(?:_[0-9]+)?\.json$" for x in names})


def q_collision_measures(spark: SparkSession, d: str) -> DataFrame:
    """Five counts of groups with more than one distinct value, from one reading."""
    li = _t(spark, d, "lineitem")
    return selection.collisions({"order has parts": ("l_orderkey", "l_partkey"), "part has orders": ("l_partkey", "l_orderkey"), "part has suppliers": ("l_partkey", "l_suppkey"), "line has flags": ("l_linenumber", "l_returnflag"), "flag has status": ("l_returnflag", "l_linestatus")}, li)


def q_strongest_tier(spark: SparkSession, d: str) -> DataFrame:
    """The strongest tier of each customer and status, the first seen among equals."""
    o = _t(spark, d, "orders").withColumn("tier", scores.evidence_tier(F.when(F.col("o_orderkey") % 3 == 0, "entity_principal").otherwise("agent"), F.col("o_orderkey") % 11 == 0))
    rank = scores.of_code(F.col("tier"), scores.TIERS)
    picked = o.groupBy("o_custkey", "o_orderstatus").agg(F.min_by(F.struct("tier", "o_orderkey"), F.struct(-rank, "o_orderkey")).alias("b"))
    return picked.select("o_custkey", "o_orderstatus", "b.tier", "b.o_orderkey")


def q_best_group(spark: SparkSession, d: str) -> DataFrame:
    """The best part of each supplier: most lines, then greatest quantity, then smallest number."""
    g = _t(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))
    return selection.best(g, "l_suppkey", [-F.col("n"), -F.col("q"), F.col("l_partkey")], "l_partkey", "n", "q")


def q_first_occurrence(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return selection.first_occurrence(e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


def q_nulls_last_order(spark: SparkSession, d: str) -> DataFrame:
    """The first ten rows by a value from high to low, nulls last, then by key."""
    c = _t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.round("c_acctbal", 0)).alias("v"))
    return c.orderBy(F.col("v").desc_nulls_last(), "c_custkey").limit(10).select("c_custkey", "v")


def q_xorshift_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twelve customers drawn by a fixed generator, in draw order, from ranks by name."""
    ranked = documents.ranked(_t(spark, d, "customer").select("c_name", "c_custkey"), "c_name", work_folder(spark, "sample"))
    return selection.sample(ranked, 12).select("draw", "c_custkey")


def q_address_tenants(spark: SparkSession, d: str) -> DataFrame:
    """Customers that share an address hash with another one, each tenant once."""
    c = _t(spark, d, "customer").select("c_custkey", F.sha2(F.concat_ws(" ", "c_nationkey", "c_mktsegment"), 256).alias("h"), "c_acctbal")
    tenants = c.where("c_acctbal > 9000").select("h", F.col("c_custkey").alias("tenant"))
    return c.join(tenants, "h").where("c_custkey <> tenant").select("c_custkey", "tenant").distinct()


def q_first_profile(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers met with the first customer profile of the same normalised name, once per pair."""
    c = _t(spark, d, "customer").select("c_custkey", F.explode(F.array(F.concat(F.lit("co "), F.col("c_nationkey").cast("string")), F.concat(F.lit("CO-"), F.col("c_nationkey").cast("string")))).alias("n"))
    key = F.regexp_replace(F.lower("n"), "[^a-z0-9]", "")
    first = c.groupBy(key.alias("k")).agg(F.min("c_custkey").alias("profile"))
    s = _t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("co"), F.col("s_nationkey").cast("string")).alias("k"))
    return s.join(first, "k").select("s_suppkey", "profile").distinct()


def q_id_join(spark: SparkSession, d: str) -> DataFrame:
    """An optional id lookup: rows, rows with an id, and ids that no row has."""
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    ids = _t(spark, d, "events").where("event_id % 2 = 0").select(F.col("event_id").alias("k"), F.lit(True).alias("has"))
    return c.join(ids, "k", "full").agg(F.count("*").alias("n"), F.count("has").alias("n_ids"), F.count_if(F.col("has") & (F.col("k") >= 0)).alias("n_known"))


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    """Squares as GeoJSON: single, with a hole, twice, open or broken."""
    k = F.col("p_partkey")
    s = k.cast("string")
    ring = lambda a: F.concat(F.lit("[["), a, F.lit(",0],["), a, F.lit(",9],[99,9],["), a, F.lit(",0]]"))
    inner = "[[1,1],[1,2],[2,2],[1,1]]"
    single = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(s), F.lit("]}"))
    holed = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(s), F.lit(f',{inner}]}}'))
    double = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring(s), F.lit(f"],[{inner},{inner}]]}}"))
    open_ = F.lit('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,2]]]}')
    text = F.when(k % 5 == 0, single).when(k % 5 == 1, holed).when(k % 5 == 2, double).when(k % 5 == 3, open_).otherwise("{}")
    return geometry.polygons(_t(spark, d, "part").select("p_partkey", "p_size", text.alias("geometry")))


def q_ring_rows(spark: SparkSession, d: str) -> DataFrame:
    return geometry.ring_rows(_shapes(spark, d), "p_partkey").select("p_partkey", "polygon", "ring", "is_interior", "points")


def q_ring_totals(spark: SparkSession, d: str) -> DataFrame:
    return geometry.totals(_shapes(spark, d))


def q_exact_multipolygon(spark: SparkSession, d: str) -> DataFrame:
    """Per group of shapes the number of polygons that remain: one where all agree, all in turn where not."""
    s = _shapes(spark, d).where("p_partkey % 5 = 0 or (p_partkey % 5 = 1 and p_size > 25)").withColumn("g", F.floor(F.col("p_partkey") / 5).cast("bigint"))
    return geometry.exact_multipolygon(s, "g", "p_partkey").select("g", F.size("polygons").cast("bigint").alias("n"))


def q_ring_match(spark: SparkSession, d: str) -> DataFrame:
    """Components met with the one raw polygon of equal outer ring; none or several give no match."""
    s = _shapes(spark, d).where("polygons is not null")
    components = geometry.ring_rows(s, "p_partkey").where("not is_interior").select("p_partkey", F.col("polygon").alias("part"), F.when(F.col("p_partkey") % 10 == 2, F.slice("position", 1, 3)).otherwise(F.col("position")).alias("ring"))
    return geometry.match_rings(components, s, "p_partkey", "part").select("p_partkey", "part", "n", F.col("polygon").cast("string").alias("polygon"))


_CLASSES = "address building deed file flood geometry layout lot ownership parcel person sales structure tax".split()
ORACLE = {
    "q_prefix_scope": "SELECT 'src1_' || source AS s, count(*) AS n FROM documents WHERE doc_id % 3 = 0 GROUP BY 1",
    "q_any_of_list": "SELECT count(*) FILTER (c_nationkey IN (1, 5, 7)) AS n, 'few' AS scope FROM customer UNION ALL SELECT count(*), 'all' FROM customer UNION ALL SELECT 0, 'none' UNION ALL SELECT count(*), 'ordered' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "q_like_any": "SELECT p_partkey FROM part WHERE (p_type ILIKE '%brass%' OR p_type ILIKE '%#13' OR p_type ILIKE 'steel%' OR p_brand ILIKE '%brass%' OR p_brand ILIKE '%#13' OR p_brand ILIKE 'steel%' OR p_name ILIKE '%brass%' OR p_name ILIKE '%#13' OR p_name ILIKE 'steel%') AND p_type NOT ILIKE '%small%' AND p_size <> 3",
    "q_json_contains": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_type(props) = 'OBJECT' AS is_object FROM events WHERE json_extract_string(props, '$.k') IN ('5', '7')",
    "q_exclusion_list": "SELECT c_nationkey, count(*) AS n, 'table' AS list FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1 UNION ALL SELECT c_nationkey, count(*), 'empty' FROM customer GROUP BY 1",
    "q_joined_or_null": "SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN p_type WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_brand || ' ' || p_type END AS line FROM part",
    "q_public_columns": "SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_name, false AS has_owner, CAST(0 AS BIGINT) AS owner_count FROM customer",
    "q_optional_filter": "SELECT count(*) AS n, true AS everything FROM part UNION ALL SELECT count(*), false FROM part WHERE p_size > 40",
    "q_view_columns": "SELECT o_orderkey, coalesce(n_name, c_mktsegment, o_orderpriority) AS place, coalesce(event_type, o_orderstatus) AS kind FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON c_nationkey = n_nationkey LEFT JOIN events ON o_orderkey = event_id",
    "q_measure_row": "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT o_custkey) FROM orders) AS customers, (SELECT count(*) FROM orders WHERE o_totalprice > 100000) AS large, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS closed, (SELECT count(*) FROM lineitem) AS lines, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS parts, (SELECT count(*) FROM lineitem WHERE l_discount > 0.05) AS cheap, (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)) AS unsold",
    "q_candidate_groups": """WITH s AS (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 8 GROUP BY 1),
g AS (SELECT o_custkey, count(*) AS permits, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS kinds, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus <> 'P') AS l, count(*) FILTER (o_totalprice > 200000) AS i FROM orders GROUP BY 1)
SELECT o_custkey, permits, kinds, samples, 1000 + least(f, 20) * 45 + least(l, 30) * 20 + least(i, 20) * 6 + least(permits, 30) AS score FROM g JOIN s USING (o_custkey)""",
    "q_keyword_stats": """WITH p AS (SELECT p_brand, p_partkey % 3 = 0 AS w, p_partkey % 5 = 0 AS c, p_partkey % 7 = 0 AND p_partkey % 5 <> 0 AS f FROM part), m AS (SELECT * FROM p WHERE w OR c OR f)
SELECT p_brand, count(*) AS n, array_to_string(list_filter([CASE WHEN bool_or(c) THEN 'cold storage' END, CASE WHEN bool_or(f) THEN 'factory' END, CASE WHEN bool_or(w) THEN 'warehouse' END], lambda x: x IS NOT NULL), '|') AS keywords FROM m GROUP BY 1""",
    "q_file_classes": "SELECT class, count(event_id) AS n FROM (SELECT unnest(range(0, 14)) AS i, unnest([" + ", ".join(f"'{x}'" for x in _CLASSES) + "]) AS class) LEFT JOIN (SELECT * FROM events WHERE event_id % 10 <> 0) ON event_id % 14 = i GROUP BY 1",
    "q_collision_measures": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count(*) FILTER (d > 1) AS n FROM (SELECT count(DISTINCT {v}) AS d FROM lineitem GROUP BY {g})"
        for m, g, v in (("order has parts", "l_orderkey", "l_partkey"), ("part has orders", "l_partkey", "l_orderkey"), ("part has suppliers", "l_partkey", "l_suppkey"), ("line has flags", "l_linenumber", "l_returnflag"), ("flag has status", "l_returnflag", "l_linestatus"))
    ),
    "q_strongest_tier": "SELECT DISTINCT ON (o_custkey, o_orderstatus) o_custkey, o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN 'high' WHEN o_orderkey % 3 = 0 THEN 'medium' ELSE 'low' END AS tier, o_orderkey FROM orders ORDER BY o_custkey, o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 3 END, o_orderkey",
    "q_best_group": "SELECT DISTINCT ON (l_suppkey) l_suppkey, l_partkey, n, q FROM (SELECT l_suppkey, l_partkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2) ORDER BY l_suppkey, n DESC, q DESC, l_partkey",
    "q_first_occurrence": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2",
    "q_nulls_last_order": "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN round(c_acctbal, 0) END AS v FROM customer ORDER BY v DESC NULLS LAST, c_custkey LIMIT 10",
    "q_xorshift_sample": """WITH RECURSIVE a(i, s) AS (SELECT 0, CAST(1380926283 AS BIGINT) UNION ALL SELECT i + 1, (SELECT xor(z, (z << 5) & 4294967295) FROM (SELECT xor(y, y >> 17) AS z FROM (SELECT xor(s, (s << 13) & 4294967295) AS y))) FROM a WHERE i < 60),
r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name) - 1 AS k FROM customer), x AS (SELECT s % (SELECT count(*) FROM customer) AS k, min(i) AS i FROM a WHERE i > 0 GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY i) - 1 AS INTEGER) AS draw, c_custkey FROM x JOIN r USING (k) ORDER BY i LIMIT 12""",
    "q_address_tenants": "SELECT a.c_custkey, b.c_custkey AS tenant FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND b.c_acctbal > 9000 AND a.c_custkey <> b.c_custkey",
    "q_first_profile": "SELECT s_suppkey, min(c_custkey) AS profile FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY 1",
    "q_id_join": "SELECT count(*) AS n, count(e.k) AS n_ids, count(*) FILTER (e.k >= 0) AS n_known FROM (SELECT c_custkey AS k FROM customer) c FULL JOIN (SELECT event_id AS k FROM events WHERE event_id % 2 = 0) e ON c.k = e.k",
    "q_ring_rows": """WITH s(m, polygon, ring) AS (VALUES (0, 0, 0), (1, 0, 0), (1, 0, 1), (2, 0, 0), (2, 1, 0), (2, 1, 1)) SELECT p_partkey, polygon, ring, ring > 0 AS is_interior, 4 AS points FROM part JOIN s ON p_partkey % 5 = m""",
    "q_ring_totals": "SELECT count(*) FILTER (p_partkey % 5 < 2) + 2 * count(*) FILTER (p_partkey % 5 = 2) AS n_polygons, count(*) FILTER (p_partkey % 5 = 0) + 2 * count(*) FILTER (p_partkey % 5 = 1) + 3 * count(*) FILTER (p_partkey % 5 = 2) AS n_rings, count(*) FILTER (p_partkey % 5 IN (1, 2)) AS n_interior FROM part",
    "q_exact_multipolygon": "SELECT p_partkey // 5 AS g, count(*) AS n FROM part WHERE p_partkey % 5 = 0 OR (p_partkey % 5 = 1 AND p_size > 25) GROUP BY 1",
    "q_ring_match": """WITH s(m, part) AS (VALUES (0, 0), (1, 0), (2, 0), (2, 1)) SELECT p_partkey, part, CASE WHEN p_partkey % 10 = 2 THEN 0 ELSE 1 END AS n, CASE WHEN p_partkey % 10 <> 2 THEN CAST(part AS VARCHAR) END AS polygon FROM part JOIN s ON p_partkey % 5 = m""",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
