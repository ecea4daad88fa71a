"""Area geometry table and the lookups derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.geometry import area_km2, from_wkt, is_valid, to_wkt, wkt_type
from dwellrank.operators.spatial import within_join
from dwellrank.operators.validity import with_validity


def _usable(features: DataFrame) -> DataFrame:
    """``features`` with the geometry null where rings are broken, cross or lie outside each other."""
    judged = with_validity(features, "_valid")
    return judged.withColumn("geometry", F.when(F.col("_valid"), F.col("geometry"))).drop("_valid")


def area_geometry(features: DataFrame) -> DataFrame:
    """Area, geometry (null when invalid) and well-known text."""
    named = features.select("neighbourhood", "geometry", to_wkt(F.col("geometry"), F.col("geometry_type")).alias("geometry_wkt"))
    return _usable(named)


def area_geometry_from_text(texts: DataFrame) -> DataFrame:
    """Area, geometry type, geometry and the text itself, from ``neighbourhood`` and ``geometry_wkt``.

    Text that does not parse and geometries that are not valid give null, never an error.
    """
    text = F.col("geometry_wkt")
    parsed = texts.select("neighbourhood", wkt_type(text).alias("geometry_type"), from_wkt(text).alias("geometry"), "geometry_wkt")
    return _usable(parsed)


def area_sizes(features: DataFrame) -> DataFrame:
    """Area in square kilometres; several features of one area add up."""
    return (
        features.filter(is_valid(F.col("geometry")))
        .groupBy("neighbourhood")
        .agg(F.sum(area_km2(F.col("geometry"))).alias("area_km2"))
    )


def stop_lookup(stops: DataFrame, areas: DataFrame) -> DataFrame:
    """The area of every stop that lies in one."""
    located = stops.select(
        "stop_id", F.col("stop_lon").try_cast("double").alias("longitude"), F.col("stop_lat").try_cast("double").alias("latitude")
    ).dropna(subset=["longitude", "latitude"])
    return within_join(located, areas.select("neighbourhood", "geometry"), "inner").select("stop_id", "neighbourhood")
