"""The marts over record tables that are derived from the harness tables by SQL that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastra.operators import marts

#: Record tables in SQL; VARCHAR and lpad mean the same in both engines.
TABLES = {
    "properties": """SELECT 'P' || c_custkey AS property_id, 'L' || (c_custkey % 700) AS parcel_id, 'A' || (c_custkey % 900) AS address_id,
CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 <> 1 THEN 'R' || (c_custkey % 1200) END AS request_identifier, '12-' || lpad(CAST(c_custkey % 800 AS VARCHAR(9)), 4, '0') || '.0' AS parcel_identifier,
CASE WHEN c_custkey % 10 = 0 THEN 'other_appraiser' ELSE 'lee_appraiser' END AS source_system, c_mktsegment AS property_type, CASE WHEN c_custkey % 3 = 0 THEN 'Retail' END AS property_usage_type,
CAST(1950 + c_custkey % 70 AS INT) AS property_structure_built_year, CASE c_custkey % 5 WHEN 0 THEN '1200.5' WHEN 1 THEN '1e3' WHEN 2 THEN 'n/a' END AS livable_floor_area, CAST(c_custkey % 3000 AS VARCHAR(9)) AS total_area, c_name AS subdivision FROM customer""",
    "parcels": "SELECT 'L' || c_custkey AS parcel_id, CASE WHEN c_custkey % 3 = 0 THEN 'Q' || c_custkey ELSE '' END AS request_identifier, n_name AS county_name, 'FL' AS state_code FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey < 690",
    "addresses": """SELECT 'A' || c_custkey AS address_id, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR(9)) END AS street_number, CASE WHEN c_custkey % 3 = 0 THEN 'Oak' END AS street_name, CASE WHEN c_custkey % 6 = 0 THEN 'ST' ELSE '' END AS street_suffix_type,
CASE WHEN c_custkey % 9 = 0 THEN 'Naples' END AS city_name, CASE WHEN c_custkey % 2 = 0 THEN '34102' END AS postal_code, CASE WHEN c_custkey % 4 <> 3 THEN c_custkey || ' Elm Ave, Bonita, FL 34134' END AS unnormalized_address, 'key ' || (c_custkey % 400) AS normalized_address_key FROM customer WHERE c_custkey < 880""",
    "taxes": "SELECT o_orderkey AS tax_id, 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 7 <> 0 THEN 2000 + o_orderkey % 5 END AS tax_year, CAST(o_totalprice AS DECIMAL(18,2)) AS property_assessed_value_amount, CAST(o_orderkey AS DECIMAL(18,2)) AS property_market_value_amount, CASE WHEN o_orderkey % 2 = 0 THEN CAST(5 AS DECIMAL(18,2)) END AS property_land_amount FROM orders",
    "property_valuations": "SELECT 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS current_avm_value FROM orders WHERE o_orderkey % 3 = 0",
    "structures": "SELECT o_orderkey AS structure_id, 'P' || o_custkey AS property_id, o_orderstatus AS exterior_wall_material_primary, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS roof_covering_material FROM orders WHERE o_custkey % 3 <> 0",
    "lots": "SELECT o_orderkey AS lot_id, 'P' || o_custkey AS property_id, CASE o_orderkey % 3 WHEN 0 THEN '1.25' WHEN 1 THEN 'big' END AS lot_size_acre, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 9000 AS VARCHAR(9)) END AS lot_area_sqft FROM orders WHERE o_custkey % 7 <> 0",
    "layouts": "SELECT 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 1000 AS DECIMAL(18,2)) END AS livable_area_sq_ft, CAST(o_orderkey % 500 AS DECIMAL(18,2)) AS area_under_air_sq_ft FROM orders WHERE o_custkey % 2 = 0",
    "geometries": "SELECT o_orderkey AS geometry_id, 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 3 <> 0 THEN 26 + CAST(o_orderkey % 100 AS DOUBLE) / 128 END AS latitude, CASE WHEN o_orderkey % 5 <> 0 THEN -81 - CAST(o_orderkey % 100 AS DOUBLE) / 128 END AS longitude FROM orders",
    "ownerships": "SELECT o_orderkey AS ownership_id, 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS owned_by, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 4 AS DECIMAL(7,4)) END AS ownership_percentage, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus = 'F' END AS owner_occupied_indicator FROM orders",
    "sales_histories": "SELECT o_orderkey AS sales_history_id, 'P' || o_custkey AS property_id, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS ownership_transfer_date, CAST(o_totalprice AS DECIMAL(18,2)) AS purchase_price_amount FROM orders WHERE o_custkey % 5 <> 0",
    "property_improvements": """SELECT CAST(o_orderkey AS VARCHAR(20)) AS property_improvement_id, 'P' || o_custkey AS property_id, 'L' || (o_custkey % 700) AS parcel_id, CASE WHEN o_orderkey % 3 = 0 THEN '12' || lpad(CAST(o_custkey % 800 AS VARCHAR(9)), 4, '0') || '0' WHEN o_orderkey % 3 = 1 THEN '' END AS parcel_identifier,
o_orderkey % 40 AS contractor_company_id, CASE WHEN o_orderkey % 4 = 0 THEN 'lee_accela' WHEN o_orderkey % 4 = 1 THEN 'leesburg_accela' ELSE 'city_permits' END AS source_system, 'N' || o_orderkey AS permit_number, o_orderpriority AS improvement_type, o_orderstatus AS improvement_status, ' ' AS improvement_action,
CAST(o_orderdate AS DATE) AS permit_issue_date, CAST(o_orderdate AS DATE) AS application_received_date, CAST(NULL AS DATE) AS final_inspection_date, CAST(NULL AS DATE) AS permit_close_date, CAST(NULL AS DATE) AS completion_date, CAST(NULL AS DATE) AS expiration_date, CAST(o_orderdate AS DATE) AS opened_date,
' roof ' AS project_description, CAST(NULL AS VARCHAR(9)) AS description, CASE WHEN o_orderkey % 2 = 0 THEN '12500.00' ELSE ' ' END AS estimated_job_value, '350.5' AS fee FROM orders""",
    "companies": "SELECT s_suppkey AS company_id, CASE WHEN s_suppkey % 9 <> 0 THEN 'ACME ' || s_suppkey || ', Inc.' ELSE '' END AS name FROM supplier",
    "business_reputation_profiles": "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'BBB-x' ELSE 'other' END AS provider, CASE WHEN s_suppkey % 4 = 0 THEN 'acme' || s_suppkey || 'inc' END AS normalized_name, CASE WHEN s_suppkey % 3 = 0 THEN 'Acme ' || s_suppkey || ' inc' END AS name, CAST(NULL AS VARCHAR(9)) AS legal_name FROM supplier",
    "business_registration_addresses": "SELECT 'A' || s_suppkey AS address_id, CASE WHEN s_suppkey % 2 = 0 THEN 'PRINCIPAL' ELSE 'MAILING' END AS address_role FROM supplier",
    "unnormalized_addresses": "SELECT c_custkey AS unnormalized_address_id, CASE WHEN c_custkey % 5 <> 0 THEN 'lee_appraiser' ELSE 'x' END AS source_system, CASE WHEN c_custkey % 8 <> 0 THEN 'R' || (c_custkey % 500) ELSE '' END AS request_identifier, CASE WHEN c_custkey % 3 = 0 THEN 'VACANT' ELSE c_custkey || ' Fir Rd, Estero, FL 33928' END AS full_address FROM customer",
}


def tables(spark: SparkSession, d: str) -> marts.Tables:
    given = {n: spark.read.parquet(f"{d}/{n}.parquet") for n in ("customer", "nation", "orders", "supplier")}
    # Numbers are cast where SQL joins them to text, which one of the engines does not do by itself under ANSI rules.
    return {n: spark.sql(_bound(q), **{k: f for k, f in given.items() if f"{{{k}}}" in _bound(q)}) for n, q in TABLES.items()}


def _bound(sql: str) -> str:
    for n in ("customer", "nation", "orders", "supplier"):
        sql = sql.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n}", f"JOIN {{{n}}}")
    return sql


def q_query_table(spark: SparkSession, d: str) -> DataFrame:
    made = marts.query_table(tables(spark, d), "lee_appraiser")
    # Whole numbers and truth values that may be null are compared as text.
    return made.withColumns({c: made[c].cast("string") for c in ("owner_count", "owner_occupied", "hoa_flag")})


def q_permit_table(spark: SparkSession, d: str) -> DataFrame:
    return marts.permit_table(tables(spark, d), "lee")


def q_geo_index(spark: SparkSession, d: str) -> DataFrame:
    """Orders as mapped rows: one entry per folio with the greatest value; rows without a finite place are left out."""
    rows = spark.sql(f"SELECT * FROM ({GEO.replace('FROM orders', 'FROM {orders}')}) AS g", orders=spark.read.parquet(f"{d}/orders.parquet"))
    return marts.geo_index(rows, ["row_no"])


GEO = "SELECT o_orderkey AS row_no, '12' || (o_custkey % 90) AS parcel_identifier, CASE WHEN o_custkey % 3 = 0 THEN 'R' || o_custkey END AS request_identifier, CASE WHEN o_custkey % 2 = 0 THEN 'F' || o_custkey ELSE '' END AS folio, CASE WHEN o_orderkey % 4 = 0 THEN 'NaN' ELSE '26.' || (o_orderkey % 10) END AS latitude, CASE WHEN o_orderkey % 9 <> 0 THEN '-81.5' END AS longitude, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 1000 AS VARCHAR(9)) END AS current_avm_value, o_orderstatus AS property_type FROM orders"
_WITH = "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in TABLES.items())
_NUM = "CASE WHEN regexp_matches({0}, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST({0} AS DOUBLE) END"

ORACLE = {
    "q_query_table": _WITH
    + rf""",
p AS (SELECT DISTINCT ON (folio) * FROM (SELECT properties.*, county_name, state_code, coalesce(nullif(properties.request_identifier, ''), nullif(parcels.request_identifier, ''), parcel_identifier) AS folio, regexp_replace(parcel_identifier, '[^0-9]', '', 'g') AS plain
  FROM properties LEFT JOIN parcels USING (parcel_id) WHERE source_system = 'lee_appraiser') ORDER BY folio, property_id),
tax AS (SELECT DISTINCT ON (property_id) * FROM taxes ORDER BY property_id, tax_year DESC NULLS LAST, tax_id), st AS (SELECT DISTINCT ON (property_id) * FROM structures ORDER BY property_id, structure_id), lt AS (SELECT DISTINCT ON (property_id) * FROM lots ORDER BY property_id, lot_id),
ge AS (SELECT DISTINCT ON (property_id) * FROM geometries WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY property_id, geometry_id), sa AS (SELECT DISTINCT ON (property_id) * FROM sales_histories ORDER BY property_id, ownership_transfer_date DESC NULLS LAST, sales_history_id),
ow AS (SELECT property_id, string_agg(DISTINCT owned_by, ' | ' ORDER BY owned_by) AS owners_text, count(DISTINCT owned_by) AS owner_count, bool_or(owner_occupied_indicator) AS owner_occupied FROM ownerships WHERE owned_by <> '' GROUP BY 1),
o1 AS (SELECT DISTINCT ON (property_id) property_id, owned_by AS owner_name FROM ownerships WHERE owned_by <> '' ORDER BY property_id, ownership_percentage DESC NULLS LAST, ownership_id),
av AS (SELECT property_id, max(current_avm_value) AS avm_value FROM property_valuations GROUP BY 1), la AS (SELECT property_id, sum(livable_area_sq_ft) AS a, sum(area_under_air_sq_ft) AS b FROM layouts GROUP BY 1),
pc AS (SELECT parcel_identifier AS x, count(*) AS permit_count FROM property_improvements WHERE parcel_identifier <> '' GROUP BY 1),
sk AS (SELECT DISTINCT normalized_address_key AS x FROM business_registration_addresses JOIN addresses USING (address_id) WHERE address_role = 'PRINCIPAL'),
bn AS (SELECT regexp_replace(lower(coalesce(normalized_name, name, legal_name)), '[^a-z0-9]', '', 'g') AS n FROM business_reputation_profiles WHERE provider ILIKE '%bbb%'),
pb AS (SELECT DISTINCT parcel_identifier AS x FROM property_improvements JOIN companies ON company_id = contractor_company_id WHERE name <> '' AND regexp_replace(lower(name), '[^a-z0-9]', '', 'g') IN (SELECT n FROM bn WHERE n IS NOT NULL)),
su AS (SELECT DISTINCT ON (request_identifier) request_identifier, full_address FROM unnormalized_addresses WHERE source_system = 'lee_appraiser' AND request_identifier <> '' ORDER BY request_identifier, unnormalized_address_id),
j AS (SELECT *, nullif(concat_ws(' ', nullif(street_number, ''), nullif(street_name, ''), nullif(street_suffix_type, '')), '') AS built, full_address LIKE '%Fir Rd%' AS placed FROM p LEFT JOIN addresses USING (address_id) LEFT JOIN su ON su.request_identifier = p.request_identifier)
SELECT j.property_id, CAST(NULL AS VARCHAR) AS property_cid, folio AS request_identifier, parcel_identifier, source_system, county_name, state_code,
  coalesce(CASE WHEN placed THEN split_part(full_address, ',', 1) END, built, split_part(unnormalized_address, ',', 1)) AS address_street, coalesce(CASE WHEN placed THEN 'Estero' END, city_name, CASE WHEN unnormalized_address IS NOT NULL THEN 'Bonita' END) AS address_city,
  coalesce(CASE WHEN placed THEN '33928' END, postal_code, CASE WHEN unnormalized_address IS NOT NULL THEN '34134' END) AS address_zip, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  coalesce({_NUM.format("lot_size_acre")}, {_NUM.format("lot_area_sqft")} / 43560) AS lot_size_acre, {_NUM.format("lot_area_sqft")} AS lot_area_sqft, exterior_wall_material_primary AS exterior_wall_material, roof_covering_material, property_type, property_usage_type,
  CAST(property_structure_built_year AS BIGINT) AS built_year, coalesce({_NUM.format("livable_floor_area")}, CAST(la.a AS DOUBLE), CAST(la.b AS DOUBLE)) AS livable_floor_area, {_NUM.format("total_area")} AS total_area,
  CAST(property_assessed_value_amount AS DOUBLE) AS assessed_value, CAST(property_market_value_amount AS DOUBLE) AS market_value, CAST(property_land_amount AS DOUBLE) AS land_value, CAST(avm_value AS DOUBLE) AS avm_value, owner_name, owners_text, CAST(owner_count AS VARCHAR) AS owner_count, CAST(owner_occupied AS VARCHAR) AS owner_occupied,
  CAST(ownership_transfer_date AS VARCHAR) AS last_sale_date, CAST(purchase_price_amount AS DOUBLE) AS last_sale_price, subdivision, pc.x IS NOT NULL AS has_permits, coalesce(permit_count, 0) AS permit_count, sk.x IS NOT NULL AS has_sunbiz_tenant, pb.x IS NOT NULL AS has_bbb_contractor, CAST(NULL AS VARCHAR) AS hoa_flag
FROM j LEFT JOIN ge USING (property_id) LEFT JOIN lt USING (property_id) LEFT JOIN la USING (property_id) LEFT JOIN st USING (property_id) LEFT JOIN tax USING (property_id) LEFT JOIN av USING (property_id) LEFT JOIN ow USING (property_id) LEFT JOIN o1 USING (property_id) LEFT JOIN sa USING (property_id)
LEFT JOIN pc ON pc.x = plain LEFT JOIN sk ON sk.x = normalized_address_key LEFT JOIN pb ON pb.x = plain""",
    "q_permit_table": _WITH
    + """
SELECT property_improvement_id, property_id, nullif(parcel_identifier, '') AS parcel_identifier, permit_number, improvement_type, improvement_status, CAST(NULL AS VARCHAR) AS improvement_action, source_system, county_name, 'roof' AS project_description, CAST(NULL AS VARCHAR) AS description,
CAST(permit_issue_date AS VARCHAR) AS permit_issue_date, CAST(application_received_date AS VARCHAR) AS application_received_date, CAST(NULL AS VARCHAR) AS final_inspection_date, CAST(NULL AS VARCHAR) AS permit_close_date, CAST(NULL AS VARCHAR) AS completion_date, CAST(NULL AS VARCHAR) AS expiration_date, CAST(opened_date AS VARCHAR) AS opened_date,
CASE WHEN trim(estimated_job_value) <> '' THEN 12500.0::DOUBLE END AS estimated_job_value, 350.5::DOUBLE AS fee FROM property_improvements LEFT JOIN parcels USING (parcel_id) WHERE starts_with(source_system, 'lee_')""",
    "q_geo_index": f"""WITH g AS ({GEO}), k AS (SELECT *, coalesce(nullif(folio, ''), request_identifier, parcel_identifier) AS key FROM g WHERE latitude <> 'NaN' AND longitude IS NOT NULL)
SELECT parcel_identifier, request_identifier, folio, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, property_type, m AS current_avm_value
FROM (SELECT DISTINCT ON (key) *, max(CAST(current_avm_value AS DOUBLE)) OVER (PARTITION BY key) AS m FROM k ORDER BY key, row_no)""",
}


def queries() -> dict:
    return {k: globals()[k] for k in ORACLE}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
