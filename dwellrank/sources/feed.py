"""Live delay feed: landed messages to stop updates.

A message is one JSON line with a header and a bounded list of entities; a large feed lands as many
messages with the same header timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.constants import NO_DELAY, NO_STOP_ID
from dwellrank.schemas import FEED


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(FEED).json(path)


def stream_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same messages as a stream over newly landed files."""
    reader = spark.readStream.schema(FEED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def entity_updates(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per stop update, and one for each entity or message without any.

    ``first_of_entity`` marks one row per entity, so entities can be counted in the same pass. ``keep``
    names further columns of the messages.
    """
    entities = messages.select(
        *keep,
        F.col("header.timestamp").alias("feed_timestamp"),
        F.explode_outer("entity").alias("entity"),
    )
    return entities.select(
        *keep, "feed_timestamp", "entity", F.posexplode_outer("entity.trip_update.stop_time_update").alias("no", "update")
    ).select(
        *keep,
        "feed_timestamp",
        (F.col("entity").isNotNull() & (F.coalesce("no", F.lit(0)) == 0)).alias("first_of_entity"),
        F.col("entity.trip_update").isNotNull().alias("has_trip_update"),
        F.col("entity.vehicle").isNotNull().alias("has_vehicle"),
        F.col("entity.trip_update.trip.trip_id").alias("trip_id"),
        F.col("update.stop_id").alias("stop_id"),
        F.col("update.arrival.delay").alias("delay"),
    )


def stop_updates(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stop updates that carry both a stop id and an arrival delay."""
    return (
        messages.select(*keep, F.col("header.timestamp").alias("feed_timestamp"), F.explode("entity").alias("entity"))
        .filter(F.col("entity.trip_update").isNotNull())
        .select(*keep, "feed_timestamp", F.explode("entity.trip_update.stop_time_update").alias("update"))
        .select(*keep, "feed_timestamp", F.col("update.stop_id").alias("stop_id"), F.col("update.arrival.delay").alias("delay"))
        .filter(F.col("stop_id").isNotNull() & F.col("delay").isNotNull())
    )


def sample_updates(messages: DataFrame, limit: int = 15) -> DataFrame:
    """A few stop updates as text, with placeholders for what is missing."""
    updates = messages.select(F.explode("entity").alias("entity")).select(
        F.substring("entity.trip_update.trip.trip_id", 1, 25).alias("trip"),
        F.size("entity.trip_update.stop_time_update").alias("stop_updates"),
        F.explode("entity.trip_update.stop_time_update").alias("update"),
    )
    return (
        updates.select(
            "trip",
            "stop_updates",
            F.coalesce("update.stop_id", F.lit(NO_STOP_ID)).alias("stop_id"),
            F.coalesce(F.col("update.arrival.delay").cast("string"), F.lit(NO_DELAY)).alias("delay"),
        )
        .orderBy("trip", "stop_id", "delay", "stop_updates")
        .limit(limit)
    )
