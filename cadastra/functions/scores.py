"""Codes, grades, tiers and ordered decisions as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letter grades and their scores.
GRADES = {"A+": 95, "A": 90, "A-": 85, "B+": 80, "B": 75, "B-": 70, "C+": 65, "C": 60, "C-": 55, "D+": 50, "D": 45, "D-": 40, "F": 25}
#: Status codes of registrations.
STATUS = {
    "00": "Goodstanding", "01": "Reinstated", "02": "Intent to dissolve", "03": "Bankruptcy", "04": "Unacceptable payment", "05": "Agent vacated",
    "06": "Withdrawn", "07": "Revoked", "08": "Dissolved", "09": "Merged/Consolidated", "10": "Registered name expiration", "11": "Expired",
    "12": "Registered name cancellation", "13": "Special Act Corporation", "14": "Administratively Dissolved", "15": "Converted", "16": "Redomisticated", "17": "Ag-Coop",
}
#: Type codes of registrations.
TYPES = {"2": "Summons - Not Qualified", "3": "Registered Name Only", "4": "Domestic Business Corporation", "5": "Not-for-Profit Corporation", "6": "Foreign Business Corporation"}
#: Address roles that speak for the business itself.
AUTHORITATIVE_ROLES = ("business_address", "entity_principal", "principal_business_address", "principal_office")
#: Place datasets with an approved licence.
APPROVED_DATASETS = ("meta", "microsoft", "foursquare", "pinmeto", "krick", "rendersEO", "dac", "brightquery", "alltheplaces", "Overture", "Overture-signals")
TIERS = {"low": 1, "medium": 2, "high": 3}


def of_code(value: Column, table: dict) -> Column:
    """The table's value; null for other codes."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[value]


def grade(value: Column) -> Column:
    return of_code(F.upper(F.regexp_replace(value, r"\s+", "")), GRADES)


def band(score: Column) -> Column:
    return F.when(score >= 85, "excellent").when(score >= 70, "good").when(score >= 55, "fair").when(score.isNotNull(), "poor")


def quality_score(rating: Column, accredited: Column, complaints: Column, closed_3y: Column, closed_12m: Column, stars: Column, reviews: Column) -> Column:
    """0 to 100, two decimals; null where nothing is known."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    made = F.coalesce(grade(rating), F.lit(50)) + F.when(accredited, 5).when(~accredited, -2).otherwise(0)
    made = made - F.least(F.lit(25), 2 * F.coalesce(closed_3y, zero(complaints))) - F.least(F.lit(10), 2 * zero(closed_12m))
    made = made + F.when(stars.isNotNull() & (reviews >= 3), (stars - 3) * 4).otherwise(0)
    known = grade(rating).isNotNull() | accredited.isNotNull() | complaints.isNotNull() | stars.isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(made.cast("double"), 2))))


def evidence_tier(role: Column, corroborated: Column) -> Column:
    return F.when(corroborated, "high").when(role.isin(*AUTHORITATIVE_ROLES), "medium").otherwise("low")


def child_evidence(flags: dict[str, Column]) -> Column:
    """Why a child row is missing, the first cause that holds."""
    f = flags
    return (
        F.when(~f["achievable"] & ~f["output"] & ~f["stored"], "genuine_source_null")
        .when(f["id_mismatch"] | (f["achievable"] & ~f["output"]), "missing_or_invalid_transform_output")
        .when(~f["report"] | (f["issues"] > 0), "schema_validation_failure")
        .when(f["output"] & ~f["mapped"], "loader_mapper_rejection")
        .when(f["duplicate"], "conflict_or_deduplication")
        .when(f["output"] & ~f["stored"] & ~f["indexed"], "loader_not_merged")
        .when(f["output"] & ~f["stored"], "other")
        .when(f["stored"] & ~f["parent"], "parent_fk_resolution_failure")
        .otherwise("ok")
    )


def dataset_gate(datasets: Column) -> Column:
    """(passed, known, unknown) of dataset names: distinct, trimmed, sorted; one that is not approved fails."""
    listed = F.array_sort(F.array_distinct(F.filter(F.transform(datasets, lambda x: F.trim(x)), lambda x: x != "")))
    ok = [x.lower() for x in APPROVED_DATASETS]
    unknown = F.filter(listed, lambda x: ~F.lower(x).isin(*ok))
    return F.struct((F.size(unknown) == 0).alias("passed"), listed.alias("datasets"), unknown.alias("unknown"), F.exists(listed, lambda x: F.lower(x) == "osm").alias("osm"))
