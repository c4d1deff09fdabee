"""Query tables: one row per folio, per permit and per mapped place, from typed record tables.

Every many-to-one relation is reduced to one row per key by one aggregation with partial results before it is joined, so no
join multiplies rows; ties are broken by primary keys.  All joins are equi-joins that the planner broadcasts or sorts by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import addresses, names, readers

Tables = dict[str, DataFrame]


def pick(df: DataFrame, key: str, order: list[Column], *columns: str) -> DataFrame:
    """The columns of the first row of each key by ``order``, written for ``min``: least first, nulls last by ``later``."""
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_p")).select(key, *[F.col(f"_p.{c}") for c in columns])


def later(c: Column) -> list[Column]:
    """Order parts for dates or numbers, greatest first and nulls last."""
    days = F.datediff(c, F.lit("1970-01-01").cast("date"))
    return [c.isNull(), -days]


def greater(c: Column) -> list[Column]:
    return [c.isNull(), -c]


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _double(c: Column) -> Column:
    return c.cast("double")


def owners(df: DataFrame) -> DataFrame:
    """Owners of each property: sorted distinct names, their number, whether one lives there, and the one of the greatest share."""
    named = df.where((F.col("owned_by") != ""))
    first = F.min_by("owned_by", F.struct(*greater(F.col("ownership_percentage")), "ownership_id"))
    return named.groupBy("property_id").agg(
        F.array_join(F.array_sort(F.collect_set("owned_by")), " | ").alias("owners_text"), F.countDistinct("owned_by").alias("owner_count"), F.bool_or("owner_occupied_indicator").alias("owner_occupied"), first.alias("owner_name")
    )


def tenant_keys(registration_addresses: DataFrame, address: DataFrame) -> DataFrame:
    """Address keys of principal business addresses."""
    principal = registration_addresses.where("address_role = 'PRINCIPAL'")
    return principal.join(address, "address_id").where("normalized_address_key is not null").select(F.col("normalized_address_key").alias("tenant_key")).distinct()


def rated_permits(t: Tables) -> DataFrame:
    """Parcel ids with a permit of a contractor whose name a profile of the bureau has."""
    name = F.coalesce("normalized_name", "name", "legal_name")
    profiles = t["business_reputation_profiles"].where(F.col("provider").ilike("%bbb%") & name.isNotNull()).select(names.joined_key(name).alias("n")).distinct()
    companies = t["companies"].where("name <> ''").select(F.col("company_id").alias("contractor_company_id"), names.joined_key(F.col("name")).alias("n"))
    return t["property_improvements"].join(companies.join(profiles, "n", "left_semi"), "contractor_company_id").select(F.col("parcel_identifier").alias("rated_parcel")).distinct()


def query_table(t: Tables, source: str, cids: DataFrame | None = None) -> DataFrame:
    """One row per folio of a source, 37 columns."""
    p = t["properties"].where(F.col("source_system") == source)
    parcels = t["parcels"].select("parcel_id", F.col("request_identifier").alias("parcel_request"), "county_name", "state_code")
    address = t["addresses"].select("address_id", "street_number", "street_name", "street_suffix_type", "city_name", "postal_code", "unnormalized_address", "normalized_address_key")
    tax = pick(t["taxes"], "property_id", [*greater(F.col("tax_year")), F.col("tax_id")], "property_assessed_value_amount", "property_market_value_amount", "property_land_amount")
    avm = t["property_valuations"].groupBy("property_id").agg(F.max("current_avm_value").alias("avm_value"))
    structure = pick(t["structures"], "property_id", [F.col("structure_id")], "exterior_wall_material_primary", "roof_covering_material")
    lot = pick(t["lots"], "property_id", [F.col("lot_id")], "lot_size_acre", "lot_area_sqft")
    layout = t["layouts"].groupBy("property_id").agg(F.sum("livable_area_sq_ft").alias("livable_sum"), F.sum("area_under_air_sq_ft").alias("air_sum"))
    place = pick(t["geometries"].where("latitude is not null and longitude is not null"), "property_id", [F.col("geometry_id")], "latitude", "longitude")
    sale = pick(t["sales_histories"], "property_id", [*later(F.col("ownership_transfer_date")), F.col("sales_history_id")], "ownership_transfer_date", "purchase_price_amount")
    permits = t["property_improvements"].where("parcel_identifier <> ''").groupBy(F.col("parcel_identifier").alias("permit_parcel")).agg(F.count("*").alias("permit_count"))
    situs = pick(t["unnormalized_addresses"].where((F.col("source_system") == source) & (F.col("request_identifier") != "")), "request_identifier", [F.col("unnormalized_address_id")], "full_address")
    tenants = tenant_keys(t["business_registration_addresses"], t["addresses"])
    out = p.join(parcels, "parcel_id", "left")
    out = out.withColumn("folio", F.coalesce(_blank(F.col("request_identifier")), _blank(F.col("parcel_request")), "parcel_identifier"))
    # The property of each folio is chosen before anything is joined to it.
    first = out.groupBy("folio").agg(F.min("property_id").alias("property_id"))
    out = out.join(first.select("property_id"), "property_id", "left_semi").withColumn("plain_parcel", addresses.parcel_digits(F.col("parcel_identifier")))
    out = out.join(address, "address_id", "left")
    for dim in (place, lot, layout, structure, tax, avm, owners(t["ownerships"]), sale):
        out = out.join(dim, "property_id", "left")
    out = out.join(permits, F.col("plain_parcel") == F.col("permit_parcel"), "left").join(tenants, F.col("normalized_address_key") == F.col("tenant_key"), "left")
    out = out.join(rated_permits(t), F.col("plain_parcel") == F.col("rated_parcel"), "left").join(situs, "request_identifier", "left")
    known = cids if cids is not None else p.sparkSession.createDataFrame([], "property_id string, cid string")
    out = out.join(known, "property_id", "left")
    plain = lambda c: _double(readers.plain_decimal(F.col(c)))
    own = addresses.situs(F.col("full_address"), F.col("street_number"), F.col("street_name"), F.col("street_suffix_type"), F.col("city_name"), F.col("postal_code"), F.col("unnormalized_address"))
    out = out.withColumn("_a", own)
    sqft = plain("lot_area_sqft")
    return out.select(
        "property_id", F.col("cid").alias("property_cid"), F.col("folio").alias("request_identifier"), "parcel_identifier", "source_system", "county_name", "state_code",
        F.col("_a.street").alias("address_street"), F.col("_a.city").alias("address_city"), F.col("_a.zip").alias("address_zip"), _double(F.col("latitude")).alias("latitude"), _double(F.col("longitude")).alias("longitude"),
        F.coalesce(plain("lot_size_acre"), sqft / 43560).alias("lot_size_acre"), sqft.alias("lot_area_sqft"), F.col("exterior_wall_material_primary").alias("exterior_wall_material"), "roof_covering_material",
        "property_type", "property_usage_type", F.col("property_structure_built_year").cast("bigint").alias("built_year"),
        F.coalesce(plain("livable_floor_area"), _double(F.col("livable_sum")), _double(F.col("air_sum"))).alias("livable_floor_area"), plain("total_area").alias("total_area"),
        _double(F.col("property_assessed_value_amount")).alias("assessed_value"), _double(F.col("property_market_value_amount")).alias("market_value"), _double(F.col("property_land_amount")).alias("land_value"),
        _double(F.col("avm_value")).alias("avm_value"), "owner_name", "owners_text", "owner_count", "owner_occupied", F.col("ownership_transfer_date").cast("string").alias("last_sale_date"),
        _double(F.col("purchase_price_amount")).alias("last_sale_price"), "subdivision", F.col("permit_parcel").isNotNull().alias("has_permits"), F.coalesce("permit_count", F.lit(0)).alias("permit_count"),
        F.col("tenant_key").isNotNull().alias("has_sunbiz_tenant"), F.col("rated_parcel").isNotNull().alias("has_bbb_contractor"), F.lit(None).cast("boolean").alias("hoa_flag"),
    )


PERMIT_TEXTS = ("property_id", "parcel_identifier", "permit_number", "improvement_type", "improvement_status", "improvement_action", "source_system", "county_name", "project_description", "description")
PERMIT_DAYS = ("permit_issue_date", "application_received_date", "final_inspection_date", "permit_close_date", "completion_date", "expiration_date", "opened_date")


def permit_table(t: Tables, prefix: str) -> DataFrame:
    """One row per permit of the sources that begin with ``prefix`` and an underscore, 20 columns."""
    permits = t["property_improvements"].where(F.col("source_system").startswith(f"{prefix}_"))
    out = permits.join(t["parcels"].select("parcel_id", "county_name"), "parcel_id", "left")
    numbers = [readers.number(F.col(c).cast("string")).alias(c) for c in ("estimated_job_value", "fee")]
    return out.select("property_improvement_id", *[readers.text(F.col(c)).alias(c) for c in PERMIT_TEXTS], *[F.col(c).cast("string").alias(c) for c in PERMIT_DAYS], *numbers)


def geo_index(rows: DataFrame, order: list[str]) -> DataFrame:
    """One entry per folio (or parcel where that is blank) with a finite place: the first place by ``order``, the greatest value."""
    lat, lon, avm = (readers.number(F.col(c)) for c in ("latitude", "longitude", "current_avm_value"))
    placed = rows.withColumns({"_lat": lat, "_lon": lon, "_avm": avm, "_key": F.coalesce(_blank(F.col("folio")), _blank(F.col("request_identifier")), "parcel_identifier")}).where("_lat is not null and _lon is not null")
    first = F.min_by(F.struct("parcel_identifier", "request_identifier", "folio", F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"), "property_type"), F.struct(*order))
    return placed.groupBy("_key").agg(first.alias("e"), F.max("_avm").alias("current_avm_value")).select("e.*", "current_avm_value")
