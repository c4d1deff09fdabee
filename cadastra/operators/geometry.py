"""Rings and polygons as nested arrays: rows per ring, agreement of components, exact matches and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import json_values

POLYGON, MULTI = "array<array<array<double>>>", "array<array<array<array<double>>>>"


def polygons(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``df`` with ``polygons``, the valid polygons of a GeoJSON Polygon or MultiPolygon text; broken or open rings make it null."""
    g = F.col(geometry)
    kind, coordinates = F.get_json_object(g, "$.type"), F.get_json_object(g, "$.coordinates")
    many = F.when(kind == "Polygon", F.array(F.from_json(coordinates, POLYGON))).when(kind == "MultiPolygon", F.from_json(coordinates, MULTI))
    valid = lambda r: json_values.ring(F.to_json(r)).isNotNull()
    good = F.forall("polygons", lambda p: p.isNotNull() & (F.size(p) > 0) & F.forall(p, valid))
    return df.withColumn("polygons", many).withColumn("polygons", F.when(F.coalesce(good & (F.size("polygons") > 0), F.lit(False)), F.col("polygons")))


def ring_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, polygon, ring, is_interior, points, position): one row per ring, ordinals from 0."""
    parts = df.select(key, F.posexplode("polygons").alias("polygon", "p"))
    rings = parts.select(key, "polygon", F.posexplode("p").alias("ring", "position"))
    return rings.select(key, "polygon", "ring", (F.col("ring") > 0).alias("is_interior"), F.size("position").alias("points"), "position")


def totals(df: DataFrame) -> DataFrame:
    """Polygons, rings and interior rings of all rows."""
    rings = F.aggregate("polygons", F.lit(0), lambda a, p: a + F.size(p))
    inner = F.aggregate("polygons", F.lit(0), lambda a, p: a + F.greatest(F.size(p) - 1, F.lit(0)))
    total = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    some = df.where("polygons is not null")
    return some.agg(total(F.size("polygons")).alias("n_polygons"), total(rings).alias("n_rings"), total(inner).alias("n_interior"))


def exact_multipolygon(df: DataFrame, key: str, part: str) -> DataFrame:
    """(key, polygons): where all components hold the same geometry that one, otherwise the polygons of all in order of the part."""
    whole = F.to_json("polygons")
    grouped = df.where("polygons is not null").groupBy(key).agg(F.countDistinct(whole).alias("n"), F.min_by("polygons", part).alias("one"), F.array_sort(F.collect_list(F.struct(part, "polygons"))).alias("all"))
    return grouped.select(key, F.when(F.col("n") == 1, F.col("one")).otherwise(F.flatten(F.transform("all", lambda x: x["polygons"]))).alias("polygons"))


def match_rings(components: DataFrame, raw: DataFrame, key: str, part: str) -> DataFrame:
    """(key, part, n, polygon): the raw polygons whose outer ring equals that of a component, and which if it is exactly one."""
    outer = lambda p: F.sha2(F.to_json(p), 256)
    found = raw.select(key, F.posexplode("polygons").alias("polygon", "p")).select(key, "polygon", outer(F.get("p", F.lit(0))).alias("h"))
    wanted = components.select(key, part, outer(F.col("ring")).alias("h"))
    met = wanted.join(found, [key, "h"], "left").groupBy(key, part).agg(F.count("polygon").alias("n"), F.min("polygon").alias("polygon"))
    return met.select(key, part, "n", F.when(F.col("n") == 1, F.col("polygon")).alias("polygon"))
