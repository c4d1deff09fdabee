"""Scalar functions over fixed cases: Spark computes the results, the oracle SQL lists the expected values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import addresses, json_values, names, permits, readers, scores

C = F.col


@dataclass(frozen=True)
class Golden:
    """Cases are rows of inputs and expected outputs; both schemas are lists of ``name type``."""

    inputs: str
    outputs: str
    made: Callable[[], list[Column]]
    cases: tuple


def _parts(s: Column, *fields: str) -> list[Column]:
    return [s[f] for f in fields]


def _listed(values: Column) -> Column:
    return F.array_join(values, "|")


GOLDEN = {
    "q_read_text": Golden(
        "v string", "t string", lambda: [readers.text(C("v"))],
        ((" a b\t", "a b"), (" x﻿", "x"), ("", None), (" \n ", None), (None, None), ("0", "0")),
    ),
    "q_read_number": Golden(
        "v string", "n double, i bigint", lambda: [readers.number(C("v")), readers.integer(C("v"))],
        (("$1,234.50", 1234.5, 1234), (" -7.9 ", -7.9, -7), ("1e3", 1000.0, 1000), (".5", 0.5, 0), ("5.", 5.0, 5), ("+3", 3.0, 3), ("1d", None, None), ("NaN", None, None), ("Infinity", None, None), ("1e400", None, None), ("", None, None), ("12 3", None, None), (None, None, None), ("1e30", 1e30, None)),
    ),
    "q_plain_decimal": Golden(
        "v string", "n double", lambda: [readers.plain_decimal(C("v")).cast("double")],
        (("12.50", 12.5), ("-3", -3.0), ("1d", None), ("1e3", None), ("NaN", None), ("", None), (" 1", None), (".5", None), ("5.", None), (None, None), ("007", 7.0)),
    ),
    "q_read_boolean": Golden(
        "v string", "b boolean", lambda: [readers.boolean(C("v"))],
        ((" Yes ", True), ("1", True), ("TRUE", True), ("y", True), ("no", False), ("0", False), ("N", False), ("false", False), ("maybe", None), ("", None), (None, None)),
    ),
    "q_read_texts": Golden(
        "v string", "l string", lambda: [_listed(readers.texts(F.split("v", ";")))],
        ((" a ;; b", "a|b"), (";", ""), (None, ""), ("x", "x")),
    ),
    "q_read_date": Golden(
        "v string", "d string", lambda: [readers.date(C("v")).cast("string")],
        (("5/6/2026", "2026-05-06"), ("2026-05-06T10:00:00Z", "2026-05-06"), ("2014-15-10", None), ("2/30/2026", None), ("2/29/2024", "2024-02-29"), ("02/29/2023", None), ("12/31/1999 ", "1999-12-31"), ("0050-01-01", None), ("1/2/26", None), ("May 6, 2026", None), ("", None), (None, None), ("2026-5-6", None)),
    ),
    "q_read_timestamp": Golden(
        "v string", "s bigint", lambda: [F.unix_seconds(readers.timestamp(C("v")))],
        (("2026-05-06T10:00:00Z", 1778061600), ("2026-05-06T10:00:00.500+02:00", 1778054400), ("nonsense", None), ("", None), (None, None), ("2026-13-06T10:00:00Z", None)),
    ),
    "q_compact_date": Golden(
        "v string", "day string, issue string", lambda: [readers.compact_date(C("v"))["day"].cast("string"), readers.compact_date(C("v"))["issue"]],
        (("19910228", "1991-02-28", None), ("19910229", None, "invalid_calendar_date"), ("00000000", None, None), ("99999999", None, None), ("20240229", "2024-02-29", None), ("20241301", None, "invalid_calendar_date"), (None, None, None)),
    ),
    "q_zip9": Golden(
        "v string", "zip string, plus_four string", lambda: _parts(readers.zip9(C("v")), "zip", "plus_four"),
        (("612650000", "61265", None), ("612651234", "61265", "1234"), ("000000000", None, None)),
    ),
    "q_normalize_name": Golden(
        "v string", "name string, key string, contractor string, canonical string",
        lambda: [names.name(C("v")), names.joined_key(C("v")), names.contractor(C("v")), names.canonical_contractor(C("v"))],
        (
            ("  ACME Corp  ", "ACME CORP", "acmecorp", "acme co", "ACME CORP"),
            ("Smith & Sons", "SMITH SONS", "smithsons", "smith and sons", "SMITH SONS"),
            ("Sun-Ray Electric, Inc.", "SUN RAY ELECTRIC INC", "sunrayelectricinc", "sun ray electric inc", "SUN RAY ELECTRIC INC"),
            ("U. S. Pools and Spas", "U S POOLS AND SPAS", "uspoolsandspas", "u s pools and spas", "US POOLS SPAS"),
            ("Bright Builders LLC", "BRIGHT BUILDERS LLC", "brightbuildersllc", "bright builders llc", "BRIGHT BUILDERS LLC"),
            ("The Company Corporation", "THE COMPANY CORPORATION", "thecompanycorporation", "the co co", "THE COMPANY CORPORATION"),
            ("Incorporated Ideas", "INCORPORATED IDEAS", "incorporatedideas", "incorporated ideas", "INCORPORATED IDEAS"),
            ("--", "", "", "", ""), ("", None, "", "", None), (None, None, "", "", None),
        ),
    ),
    "q_parcel_id": Golden(
        "v string", "id string, digits string, usable boolean", lambda: [addresses.parcel_id(C("v")), addresses.parcel_digits(C("v")), F.coalesce(addresses.usable_parcel(addresses.parcel_id(C("v"))), F.lit(False))],
        (("36-43-24-00-00001.0000", "36432400000010000", "36432400000010000", True), ("ab c", "ABC", "", False), ("", None, "", False), (None, None, None, False), ("12-3", "123", "123", False)),
    ),
    "q_postal_code": Golden(
        "v string", "code string, found string", lambda: [addresses.postal_code(C("v")), addresses.postal_code_in(C("v"))],
        (("33917-1234", "33917", "33917"), ("4980 Bayline Drive, North Fort Myers FL 33917", "49803", "33917"), ("12381 S CLEVELAND AV #501", "12381", None), ("12381 Main St Florida 33901 extra", "12381", "33901"), ("1 A St 33901 USA", "13390", "33901"), ("123", None, None), ("", None, None), (None, None, None)),
    ),
    "q_address_key": Golden(
        "v string", "address string, key string", lambda: [addresses.address(C("v")), addresses.address_key(C("v"))],
        (
            ("4980 Bayline Drive, North Fort Myers FL 33917", "4980 BAYLINE DR N FORT MYERS FL 33917", "4980 bayline dr n fort myers fl 33917"),
            ("1 southwest 2nd  terrace #4", "1 SW 2ND TER 4", "1 sw 2nd ter 4"), ("O'Hara Highway & Way", "O'HARA HWY & WAY", "o'hara hwy & way"),
            ("12.5 Northeast Parkway", "12 5 NE PKWY", "12 5 ne pkwy"), ("", None, None), (None, None, None),
        ),
    ),
    "q_street_base": Golden(
        "v string", "base string, number string", lambda: [addresses.street_base(C("v")), addresses.street_number(addresses.address_key(C("v")))],
        (
            ("12800 UNIVERSITY DRIVE STE 600 FORT MYERS FL 33907", "12800 university dr", "12800"), ("12381 S CLEVELAND AV #208", "12381 s cleveland av", "12381"),
            ("16220 OLD US 41, Fort Myers, FL 33912", "16220 old us 41", "16220"), ("COMMERCIAL", None, "commercial"), ("12 ST JAMES", None, "12"), ("12a Main Loop West", "12a main loop", "12a"),
            ("Main Street 5 Road", None, "main"), ("9 us 41", "9 us 41", "9"), ("9 old us", None, "9"), (None, None, None),
        ),
    ),
    "q_free_text_address": Golden(
        "v string", "street string, city string, postal_code string", lambda: _parts(addresses.free_text_address(C("v")), "street", "city", "postal_code"),
        (
            ("5845 CORPORATION CIRCLE, FORT MYERS, FL 33905", "5845 CORPORATION CIRCLE", "FORT MYERS", "33905"), ("100 Commerce Blvd, Cape Coral FL 33990", "100 Commerce Blvd", "Cape Coral", "33990"),
            ("123 LONE STREET", "123 LONE STREET", None, None), ("1 A St, Unit 2, Town, 33901-1234", "1 A St", "Unit 2, Town", "33901"), ("FL 33901", None, None, "33901"), (" , ", None, None, None), ("", None, None, None), (None, None, None, None),
        ),
    ),
    "q_site_address": Golden(
        "v string", "street string, city string, state string, postal_code string", lambda: _parts(addresses.site_address(C("v")), "street", "city", "state", "postal_code"),
        (
            ("100 MAIN ST, MOLINE, IL 61265", "100 MAIN ST", "MOLINE", "IL", "61265"), ("1 A, UNIT 2, MOLINE, IL 61265-0001", "1 A, UNIT 2", "MOLINE", "IL", "61265-0001"),
            ("100 MAIN ST, MOLINE IL 61265", "100 MAIN ST, MOLINE IL 61265", None, None, None), ("A, B, il 61265", "A, B, il 61265", None, None, None), ("", None, None, None, None), (None, None, None, None, None),
        ),
    ),
    "q_situs_address": Golden(
        "full string, num string, street_name string, suffix string, city_name string, zip_code string, loose string", "street string, city string, zip string",
        lambda: _parts(addresses.situs(*[C(c) for c in ("full", "num", "street_name", "suffix", "city_name", "zip_code", "loose")]), "street", "city", "zip"),
        (
            ("1 Oak Ave, Bonita, FL 34134", "2", "Elm", "ST", "Naples", "34102", "3 Fir Rd, Estero, FL 33928", "1 Oak Ave", "Bonita", "34134"),
            ("VACANT", "2", "Elm", "ST", "Naples", None, "3 Fir Rd, Estero, FL 33928", "2 Elm ST", "Naples", "33928"),
            (None, None, "", None, "", None, "3 Fir Rd, Estero, FL 33928", "3 Fir Rd", "Estero", "33928"), ("9 Bay", None, None, None, None, None, None, "9 Bay", None, None),
            (None, None, None, None, None, None, None, None, None, None),
        ),
    ),
    "q_agent_address": Golden(
        "street string, city string, zip string, four string", "line string, key string, hash_chars bigint",
        lambda: [s for a in [addresses.agent_line(C("street"), C("city"), "IL", C("zip"), C("four"))] for s in (a["line"], a["key"], F.length(a["hash"]).cast("bigint"))],
        (("1 West Street", "Moline", "61265", "0001", "1 West Street Moline IL 61265-0001", "1 w st moline il 61265-0001", 64), ("1 A", "B", "61265", None, "1 A B IL 61265", "1 a b il 61265", 64), ("1 A", "B", None, None, "1 A B IL", "1 a b il", 64), (None, "B", "61265", None, None, None, None)),
    ),
    "q_strap": Golden(
        "v string", "strap string, left_pad string", lambda: [addresses.strap(C("v")), addresses.strap_left(C("v"))],
        (("13-45-24-01-00002.0010", "13-45-24-01-00002.0010", None), ("1345240100002", "13-45-24-01-00002.0000", None), ("134524010000212", "13-45-24-01-00002.1200", "13-45-24-01-00002.0012"), ("13452401000020", "13-45-24-01-00002.0000", None), ("123", None, None), (None, None, None)),
    ),
    "q_county_codes": Golden(
        "v string", "source string, prefix string, slug string", lambda: [names.appraisal_source(C("v")), names.permit_prefix(C("v")), names.county_of_jurisdiction(C("v"))],
        (("Palm Beach", "palm_beach_appraiser", "palm_beach", "palm beach"), ("palm_beach_appraiser", "palm_beach_appraiser", "palm_beach", "palm-beach"), ("_lee_", "lee_appraiser", "lee", "lee"), (" St. Johns ", "st_johns_appraiser", "st_johns", "st. johns")),
    ),
    "q_county_of_uri": Golden(
        "v string", "sunbiz string, places string, bbb string", lambda: [names.county_of_uri(s, C("v")) for s in ("sunbiz", "overture_places", "bbb")],
        (("s3://b/sunbiz-miami-dade-corporate-quarterly-1", "miami-dade", None, None), ("s3://b/category-data/lee-county-permit-seeded/x", None, None, "lee"), ("s3://b/overture-places/Lee/y.json", None, "lee", None), ("", None, None, None), ("s3://b/x", None, None, None)),
    ),
    "q_s3_uri": Golden(
        "v string", "bucket string, key string", lambda: _parts(names.s3_uri(C("v")), "bucket", "key"),
        (("s3://b/a/c%20d.json", "b", "a/c d.json"), ("s3://b/a+c", "b", "a+c"), ("s3://b", "b", ""), ("http://b/a", None, None), ("s3:///a", None, None)),
    ),
    "q_permit_status": Golden(
        "v string", "status string, chars bigint", lambda: [permits.status(C("v")), F.length(permits.status(C("v"))).cast("bigint")],
        ((" Closed -  Complete Click here for more information on it", "Closed - Complete", 17), ("Issued Record Details: x", "Issued", 6), ("Recorded", "Recorded", 8), ("Work Location", "Work Location", 13), ("", None, None), (None, None, None), ("x" * 300, "x" * 256, 256)),
    ),
    "q_industrial_keywords": Golden(
        "a string, b string", "found string", lambda: [_listed(permits.industrial_keywords(C("a"), C("b")))],
        (("Tenant build-out for warehouse distribution space", None, "warehouse|distribution"), ("Retail storefront interior remodel", "", ""), ("processing", "plant", "plant"), ("Mini-Warehouse and self storage", "Flex INDUSTRIAL", "industrial|warehouse|self storage|flex industrial"), ("industrially", "warehouses", ""), (None, None, "")),
    ),
    "q_permit_flags": Golden(
        "number string, kind string, note string", "commercial boolean, live boolean", lambda: [permits.is_commercial(C("number"), C("kind"), C("note")), permits.is_live(C("kind"), C("note"))],
        (("COM2020", "x", None, True, True), ("RES1", "Commercial reroof", None, True, True), ("RES1", None, "void - duplicate", False, False), (None, None, None, False, True), ("X", "testing", None, False, False)),
    ),
    "q_document_url": Golden(
        "v string", "storable boolean, selected boolean", lambda: [permits.is_document(C("v")), permits.is_document(C("v"), permits.DOCUMENT_MARKS[:4])],
        (("https://x/a.PDF ", True, True), ("http://x/showdocument?id=1", True, False), ("javascript:.pdf", False, False), ("ftp://x/a.pdf", False, False), ("https://x/y", False, False), ("", False, False), (None, False, False)),
    ),
    "q_candidate_score": Golden(
        ", ".join(f"{t} bigint" for t, _, _ in permits.SCORE_TERMS), "score bigint", lambda: [permits.candidate_score({t: C(t) for t, _, _ in permits.SCORE_TERMS})],
        ((1, 2, 3, 2, 1, 4, 1, 2, 1182), (0, 0, 0, 0, 0, 0, 0, 0, 1000), (99, 99, 99, 99, 99, 99, 99, 99, 1000 + 900 + 600 + 120 + 80 + 160 + 30 + 700 + 240)),
    ),
    "q_usage_score": Golden("usage string, permits bigint", "score bigint", lambda: [permits.usage_score(C("usage"), C("permits"))], (("LightManufacturing", 3, 123), ("Warehouse", 0, 100))),
    "q_fee_lines": Golden(
        "v string", "lines string, total double", lambda: [_listed(F.transform(permits.fees(C("v")), lambda f: F.concat_ws(":", f["code"], f["status"], f["day"].cast("string")))), permits.fee_total(permits.fees(C("v")))],
        (
            ("Outstanding: 1/2/2024 INV-1 $1,200.50 View Details Paid / Discounted 02/03/2024 INV-2 10 View Details", "INV-1:OUTSTANDING:2024-01-02|INV-2:PAID_OR_DISCOUNTED:2024-02-03", 1210.5),
            ("1/2/2024 A1 5.00 View Details", "A1:UNKNOWN:2024-01-02", 5.0), ("outstanding " + "x" * 250 + " 1/2/2024 A1 5.00 View Details", "A1:UNKNOWN:2024-01-02", 5.0), ("nothing", "", None),
        ),
    ),
    "q_quality_score": Golden(
        "rating string, accredited boolean, complaints bigint, closed3 bigint, closed1 bigint, stars double, reviews bigint", "score double, band string",
        lambda: [s for q in [scores.quality_score(*[C(c) for c in ("rating", "accredited", "complaints", "closed3", "closed1", "stars", "reviews")])] for s in (q, scores.band(q))],
        (("A+", True, None, 2, 1, 4.5, 3, 100.0, "excellent"), (" b - ", False, 30, None, None, None, None, 43.0, "poor"), (None, None, None, None, None, None, None, None, None), (None, None, None, None, None, 4.0, 2, 50.0, "poor"), ("F", None, 99, None, 99, 1.0, 9, 0.0, "poor"), ("NR", True, None, None, None, None, None, 55.0, "fair")),
    ),
    "q_registration_codes": Golden(
        "status string, kind string", "status_text string, kind_text string", lambda: [scores.of_code(C("status"), scores.STATUS), scores.of_code(C("kind"), scores.TYPES)],
        (("00", "4", "Goodstanding", "Domestic Business Corporation"), ("14", "9", "Administratively Dissolved", None), ("99", None, None, None)),
    ),
    "q_evidence_tier": Golden(
        "role string, corroborated boolean", "tier string", lambda: [scores.evidence_tier(C("role"), C("corroborated"))],
        (("agent", True, "high"), ("entity_principal", False, "medium"), ("agent", False, "low"), (None, False, "low")),
    ),
    "q_child_evidence": Golden(
        ", ".join(f"{x} boolean" for x in ("achievable", "output", "report", "mapped", "indexed", "stored", "parent", "duplicate", "id_mismatch")) + ", issues bigint", "cause string",
        lambda: [scores.child_evidence({x: C(x) for x in ("achievable", "output", "report", "mapped", "indexed", "stored", "parent", "duplicate", "id_mismatch", "issues")})],
        (
            (False, False, True, True, True, False, True, False, False, 0, "genuine_source_null"), (True, False, True, True, True, False, True, False, False, 0, "missing_or_invalid_transform_output"),
            (True, True, True, True, True, True, True, False, True, 0, "missing_or_invalid_transform_output"), (True, True, True, True, True, True, True, False, False, 2, "schema_validation_failure"),
            (True, True, True, False, True, True, True, True, False, 0, "loader_mapper_rejection"), (True, True, True, True, True, True, True, True, False, 0, "conflict_or_deduplication"),
            (True, True, True, True, False, False, True, False, False, 0, "loader_not_merged"), (True, True, True, True, True, False, True, False, False, 0, "other"),
            (True, True, True, True, True, True, False, False, False, 0, "parent_fk_resolution_failure"), (True, True, True, True, True, True, True, False, False, 0, "ok"),
        ),
    ),
    "q_dataset_gate": Golden(
        "v string", "passed boolean, datasets string, unknown string, osm boolean", lambda: [s for g in [scores.dataset_gate(F.split("v", ";"))] for s in (g["passed"], _listed(g["datasets"]), _listed(g["unknown"]), g["osm"])],
        (("meta; Microsoft;meta", True, "Microsoft|meta", "", False), ("OSM;meta", False, "OSM|meta", "OSM", True), ("", True, "", "", False), ("other", False, "other", "other", False)),
    ),
    "q_canonical_json": Golden(
        "v string", "canonical string", lambda: [json_values.canonical_json(C("v"))],
        (
            ('{"b":2,"a":{"d":4,"c":3}}', '{"a":{"c":3,"d":4},"b":2}'), ('[2e3, 1.50, -0, 1e21, 0.000001, 1e-7, 123456789012345680000]', "[2000,1.5,0,1e+21,0.000001,1e-7,123456789012345680000]"),
            ('{"é":"\\u00e9\\n","a":null,"A":[true,false,"x\\"y"]}', '{"A":[true,false,"x\\"y"],"a":null,"é":"é\\n"}'), ("{bad", None), ("", None), (None, None), ('"t"', '"t"'), ("NaN", None),
        ),
    ),
    "q_canonical_hash": Golden(
        "v string, w string", "same boolean, chars bigint", lambda: [json_values.json_hash(C("v")) == json_values.json_hash(C("w")), F.length(json_values.json_hash(C("v"))).cast("bigint")],
        (('{"a":1,"b":[2,3]}', ' { "b" : [2.0, 3], "a" : 1e0 } ', True, 64), ('{"a":1}', '{"a":2}', False, 64), ("[1,2]", "[2,1]", False, 64)),
    ),
    "q_denied_keys": Golden(
        "v string", "denied string", lambda: [_listed(json_values.denied_keys(C("v"), "(?i)(?:name|mail|phone)$"))],
        (('{"a":{"taxbill_name":"x"}}', "taxbill_name"), ('{"taxbill_year":1}', ""), ('[{"Mail":1},{"b":[{"Mail":2}]}]', "Mail"), ("{bad", ""), (None, "")),
    ),
    "q_alias_paths": Golden(
        "v string", "t string", lambda: [json_values.first_text(C("v"), "legal_name", "legalName", "profile.name")],
        (('{"legalName":" A "}', "A"), ('{"legal_name":"","profile":{"name":"B"}}', "B"), ('{"x":1}', None), ("{bad", None), (None, None)),
    ),
    "q_coordinate": Golden(
        "v string", "longitude double, latitude double", lambda: _parts(json_values.coordinate(C("v")), "longitude", "latitude"),
        (('{"source_payload":{"longitude":"-81.87","latitude":"26.64"}}', -81.87, 26.64), ('{"source_payload":{"X_longitude":"-190","Y_latitude":"26"}}', None, 26.0), ('{"longitude":"1"}', None, None), (None, None, None)),
    ),
    "q_ring": Golden(
        "v string", "points bigint", lambda: [F.size(json_values.ring(C("v"))).cast("bigint")],
        (("[[0,0],[1,0],[1,1],[0,0]]", 4), ("[[0,0],[1,0],[1,1],[0,1]]", None), ("[[0,0],[1,0],[0,0]]", None), ("[[0,0],[1],[1,1],[0,0]]", None), ("[[0,0,5],[1,0,5],[1,1,5],[0,0,7]]", 4), ("bad", None), (None, None), ("[]", None), ("[[],[],[],[]]", None)),
    ),
}

_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def _schema(spec: str) -> list[tuple[str, str]]:
    return [tuple(x.split()) for x in spec.split(", ")]


def _literal(value, kind: str) -> str:
    written = "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)
    # Results are compared as text where a column may be null, doubles apart.
    return f"CAST({written} AS DOUBLE)" if kind == "double" else f"CAST(CAST({written} AS {_SQL_TYPES[kind]}) AS VARCHAR)"


def _query(g: Golden) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        width = len(_schema(g.inputs))
        rows = [(k, *case[:width]) for k, case in enumerate(g.cases)]
        given = spark.createDataFrame(rows, f"case_no bigint, {g.inputs}")
        return given.select("case_no", *[(c if t == "double" else c.cast("string")).alias(n) for c, (n, t) in zip(g.made(), _schema(g.outputs))])

    return run


def _expected(g: Golden) -> str:
    width, out = len(_schema(g.inputs)), _schema(g.outputs)
    rows = ", ".join("(" + ", ".join([str(k), *[_literal(v, t) for v, (_, t) in zip(case[width:], out)]]) + ")" for k, case in enumerate(g.cases))
    return f"SELECT CAST(case_no AS BIGINT) AS case_no, {', '.join(n for n, _ in out)} FROM (VALUES {rows}) AS t(case_no, {', '.join(n for n, _ in out)})"


def queries() -> dict:
    return {k: _query(g) for k, g in GOLDEN.items()}


def oracle_sql() -> dict[str, str]:
    return {k: _expected(g) for k, g in GOLDEN.items()}
