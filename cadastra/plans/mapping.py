"""Row mappers over JSON records made of the harness tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources import mappers
from cadastra.sources.mappers import Field, Rule

RULES = (
    Rule(r"^data/tax_[0-9]+\.json$", "taxes", (Field("tax_year", "integer"), Field("property_market_value_amount", "number"), Field("property_assessed_value_amount", "number", ("property_assessed_value_amount", "assessed")))),
    Rule(r"^data/property\.json$", "properties", (Field("property_type"), Field("built", "integer", ("built_year", "property.built_year")))),
    Rule(r"^data/sales?_[0-9]+\.json$", "sales", (Field("ownership_transfer_date", "date"), Field("purchase_price_amount", "number"))),
)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Four kinds of files made of orders: taxes, properties, sales and unknown ones."""
    o, k = _t(spark, d, "orders"), F.col("o_orderkey")
    s = k.cast("string")
    tax = F.concat(F.lit('{"tax_year":"'), (2000 + k % 20).cast("string"), F.when(k % 8 == 0, '","property_market_value_amount":"$1,0').otherwise('","assessed":"'), s, F.lit('.5"}'))
    prop = F.concat(F.lit('{"property_type":" '), F.col("o_orderpriority"), F.when(k % 8 == 1, ' ","built_year":1990}').otherwise(' ","property":{"built_year":"1980.7"}}'))
    sale = F.concat(F.lit('{"purchase_price_amount":"'), F.when(k % 8 == 2, F.lit("n/a")).otherwise(s), F.lit('","ownership_transfer_date":"'), F.date_format("o_orderdate", "M/d/yyyy"), F.lit('"}'))
    file = F.when(k % 4 == 0, F.concat(F.lit("data/tax_"), s, F.lit(".json"))).when(k % 4 == 1, "data/property.json").when(k % 4 == 2, F.concat(F.lit("data/sale_"), s, F.lit(".json"))).otherwise("data/other.json")
    return o.select(F.col("o_custkey").cast("string").alias("folio"), file.alias("file"), F.when(k % 4 == 0, tax).when(k % 4 == 1, prop).when(k % 4 == 2, sale).otherwise("{}").alias("record"))


def q_mapped_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of three tables and the rejects of one dispatch, as table, key and a value."""
    t = mappers.mapped(_records(spark, d), RULES, "lee_appraiser")
    row = lambda name, v: t[name].select(F.lit(name).alias("table"), F.col("source_record_key").alias("key"), v.cast("string").alias("v"))
    lost = t["rejects"].select(F.lit("rejects").alias("table"), "folio", F.col("file").alias("v")).withColumnRenamed("folio", "key")
    return row("taxes", F.col("tax_year")).unionByName(row("properties", F.concat_ws("|", "property_type", "built"))).unionByName(row("sales", F.concat_ws("|", "ownership_transfer_date", F.col("purchase_price_amount").cast("bigint")))).unionByName(lost)


def q_tax_valuations(spark: SparkSession, d: str) -> DataFrame:
    taxes = mappers.mapped(_records(spark, d), RULES, "lee_appraiser")["taxes"]
    return mappers.tax_valuations(taxes).select("source_record_key", "current_avm_value", "valuation_date")


def q_owner_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of persons and companies split into their parts."""
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("Mary Ann van "), F.col("c_mktsegment"), F.lit(" Jr."))).when(k % 4 == 1, F.concat(F.col("c_mktsegment"), F.lit(" Homes, LLC"))).when(k % 4 == 2, F.concat(F.lit("bob "), F.col("c_mktsegment"))).otherwise("-")
    return _t(spark, d, "customer").select("c_custkey", mappers.owner(name).alias("o")).select("c_custkey", "o.kind", "o.first", "o.middle", "o.last", "o.suffix")


def q_child_rows(spark: SparkSession, d: str) -> DataFrame:
    """Links in an array of each record, by kind and address the first one."""
    link = lambda a, b: F.concat(F.lit('{"kind":"doc","url":"'), a, F.lit('","label":"'), b, F.lit('"}'))
    s = F.col("p_size").cast("string")
    text = F.concat(F.lit('{"detail":{"links":['), link(F.lit("http://a/"), s), F.lit(","), link(F.concat(F.lit("http://a/"), s), F.lit("x")), F.lit(","), link(F.lit(" http://a/ "), F.lit("later")), F.lit("]}}"))
    rows = _t(spark, d, "part").select("p_partkey", text.alias("record"))
    return mappers.children(rows, "p_partkey", "record", "detail.links", (Field("kind"), Field("url"), Field("label")), ("kind", "url"))


def _places(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    k = F.col("s_suppkey")
    text = F.concat(F.lit('{"names":{"primary":"'), F.col("s_name"), F.lit('"},"confidence":0.5,"categories":{"primary":"shop","alternate":["food","bar"]},"sources":[{"dataset":"'), F.when(k % 3 == 0, "osm").otherwise("Meta"), F.lit('","record_id":"'), k.cast("string"), F.lit('"},{"dataset":"microsoft"}]}'))
    return mappers.places(_t(spark, d, "supplier").select("s_suppkey", text.alias("record")), "s_suppkey")


def q_place_rows(spark: SparkSession, d: str) -> DataFrame:
    """Locations, categories and sources of places that pass the licence gate, and the places that do not."""
    p = _places(spark, d)
    row = lambda name, v: p[name].select(F.lit(name).alias("table"), "s_suppkey", v.alias("v"))
    return row("locations", F.concat_ws("|", "name", "primary_category")).unionByName(row("categories", F.concat_ws("|", F.col("ordinal").cast("string"), "category", F.col("is_primary").cast("string")))).unionByName(row("sources", F.concat_ws("|", "dataset", "record_id"))).unionByName(row("rejects", F.col("unknown")))


def q_link_rows(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("p_partkey").cast("string")
    c = _t(spark, d, "part").select(F.concat(F.lit("12-"), s).alias("parcel"), F.array(F.concat(F.lit("1.2."), s), F.lit(" "), F.lit("ab c")).alias("more"), F.concat(F.lit("s3://b/"), F.when(F.col("p_size") > 25, F.concat(F.lit("Folio-"), s)).otherwise("x")).alias("uri"))
    return mappers.link_rows(c, "parcel", "more", "uri")


def q_scope_sets(spark: SparkSession, d: str) -> DataFrame:
    """Distinct parcels, artifacts and address bases of manifests, counted."""
    p = _t(spark, d, "part").select(F.struct(F.col("p_brand").alias("parcelIdentifier"), F.when(F.col("p_size") > 9, F.col("p_type")).alias("appraisalOutputS3Uri"), F.lit(" ").alias("addressBase")).alias("c"), (F.col("p_partkey") % 7).alias("g"))
    sets = mappers.scope_sets(p.groupBy("g").agg(F.collect_list("c").alias("candidates")).select(F.to_json(F.struct("candidates")).alias("text")))
    counts = [df.agg(F.count("*").alias("n")).withColumn("set", F.lit(name)) for name, df in sets.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_O = "SELECT *, o_orderkey % 4 AS m, 'lee_appraiser:' || o_custkey AS f FROM orders"
ORACLE = {
    "q_mapped_tables": f"""WITH o AS ({_O}) SELECT CASE m WHEN 0 THEN 'taxes' WHEN 1 THEN 'properties' WHEN 2 THEN 'sales' ELSE 'rejects' END AS "table",
CASE m WHEN 0 THEN f || ':taxe:tax_' || o_orderkey WHEN 1 THEN f || ':property:property' WHEN 2 THEN f || ':sale:sale_' || o_orderkey ELSE CAST(o_custkey AS VARCHAR) END AS key,
CASE m WHEN 0 THEN CAST(2000 + o_orderkey % 20 AS VARCHAR) WHEN 1 THEN o_orderpriority || '|' || CASE WHEN o_orderkey % 8 = 1 THEN '1990' ELSE '1980' END WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE WHEN o_orderkey % 8 = 2 THEN '' ELSE '|' || o_orderkey END ELSE 'data/other.json' END AS v FROM o""",
    "q_tax_valuations": f"""WITH o AS ({_O}) SELECT f || ':property_valuation:tax_' || o_orderkey AS source_record_key, CAST(CASE WHEN o_orderkey % 8 = 0 THEN '10' ELSE '' END || o_orderkey || '.5' AS DOUBLE) AS current_avm_value, CAST(2000 + o_orderkey % 20 AS VARCHAR) || '-01-01' AS valuation_date FROM o WHERE m = 0""",
    "q_owner_names": """SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'company' WHEN 3 THEN NULL ELSE 'person' END AS kind, CASE c_custkey % 4 WHEN 0 THEN 'MARY' WHEN 2 THEN 'BOB' END AS first, CASE WHEN c_custkey % 4 = 0 THEN 'ANN VAN' END AS middle,
CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS last, CASE WHEN c_custkey % 4 = 0 THEN 'JR' END AS suffix FROM customer""",
    "q_child_rows": "SELECT p_partkey, 'doc' AS kind, 'http://a/' AS url, 0 AS ordinal, CAST(p_size AS VARCHAR) AS label FROM part UNION ALL SELECT p_partkey, 'doc', 'http://a/' || p_size, 1, 'x' FROM part",
    "q_place_rows": """SELECT 'locations' AS "table", s_suppkey, s_name || '|shop' AS v FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'categories', s_suppkey, x FROM supplier, (VALUES ('0|shop|true'), ('1|food|false'), ('2|bar|false')) t(x) WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'sources', s_suppkey, 'Meta|' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'sources', s_suppkey, 'microsoft' FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'rejects', s_suppkey, 'osm' FROM supplier WHERE s_suppkey % 3 = 0""",
    "q_link_rows": """WITH p AS (SELECT p_partkey, 's3://b/' || CASE WHEN p_size > 25 THEN 'Folio-' || p_partkey ELSE 'x' END AS uri, CASE WHEN p_size > 25 THEN CAST(p_partkey AS VARCHAR) END AS folio FROM part) SELECT DISTINCT id AS parcel_id, uri, folio FROM (SELECT '12' || p_partkey AS id, uri, folio FROM p UNION ALL SELECT 'ABC', uri, folio FROM p)""",
    "q_scope_sets": "SELECT count(DISTINCT p_brand) AS n, 'parcels' AS set FROM part UNION ALL SELECT count(DISTINCT p_type), 'artifacts' FROM part WHERE p_size > 9 UNION ALL SELECT 0, 'bases'",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
