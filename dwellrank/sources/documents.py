"""Nested JSON documents to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.operators.asof import asof_join
from dwellrank.schemas import AIR_QUALITY, EVENT_SEARCH, WEATHER


def read_event_search(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Event search responses as landed, one document per line or per file."""
    return spark.read.schema(EVENT_SEARCH).option("multiLine", str(multiline).lower()).json(path)


def flatten_events(documents: DataFrame) -> DataFrame:
    """One row per event, with its first venue and first classification.

    A missing or an empty list gives nulls.
    """
    event = documents.select(F.explode("_embedded.events").alias("event"))
    venue = F.get(F.col("event._embedded.venues"), F.lit(0))
    kind = F.get(F.col("event.classifications"), F.lit(0))
    return event.select(
        F.col("event.name").alias("name"),
        F.try_to_date(F.col("event.dates.start.localDate"), "yyyy-MM-dd").alias("date"),
        venue["name"].alias("venue"),
        venue["location"]["latitude"].try_cast("double").alias("latitude"),
        venue["location"]["longitude"].try_cast("double").alias("longitude"),
        kind["segment"]["name"].alias("category"),
    )


def earliest_events(events: DataFrame, limit: int = 200) -> DataFrame:
    """The next events by date, oldest first."""
    return events.orderBy(F.col("date").asc_nulls_last(), "name").limit(limit)


def _placed(documents: DataFrame, place: str | None) -> DataFrame:
    """The documents' own location, or ``place`` where they name none, as responses of the services do."""
    return documents.withColumn("location", F.coalesce("location", F.lit(place).cast("string")))


def read_weather(spark: SparkSession, path: str | list[str], place: str | None = None) -> DataFrame:
    return _placed(spark.read.schema(WEATHER).json(path), place)


def read_air_quality(spark: SparkSession, path: str | list[str], place: str | None = None) -> DataFrame:
    return _placed(spark.read.schema(AIR_QUALITY).json(path), place)


def observation_time(text: Column) -> Column:
    """A time as the services write it (to the day, minute or second, in UTC); null if it is none."""
    formats = ("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in formats])


def merge_conditions(
    weather: DataFrame, air: DataFrame, snapshot_time: Column | None = None, tolerance: Column | None = None
) -> DataFrame:
    """Each weather observation with the latest air quality of its place up to then, as one record.

    The two services report at different steps, so their times need not be equal; ``tolerance`` is the interval
    an air quality may be older, without limit by default. Weather without any has nulls there.
    An observation that was landed twice is one record, and of several with one place and time the
    largest is taken. Documents without a place belong together, and those whose time is not readable match
    where it is the same text. ``snapshot_time`` is the run time, by default the current timestamp.
    """

    def observed(documents: DataFrame, name: str) -> DataFrame:
        text = F.col("current.time")
        known = documents.filter(F.col("current").isNotNull()).groupBy("location", text.alias("observed")).agg(F.max("current").alias(name))
        at = observation_time(F.col("observed"))
        return known.select(
            F.struct(F.coalesce("location", F.lit("")).alias("place"), F.when(at.isNull(), F.col("observed")).alias("text")).alias("of"),
            F.coalesce(at, F.timestamp_seconds(F.lit(0))).alias("at"),
            F.struct("location", "observed", name).alias(name),
        )

    met = asof_join(observed(weather, "w"), observed(air, "a"), ["of"], "at", tolerance)
    return met.select("w.*", F.col("a.a").alias("a")).select(
        (snapshot_time if snapshot_time is not None else F.current_timestamp()).alias("snapshot_time"),
        "location",
        "observed",
        F.col("w.temperature_2m").alias("temperature_c"),
        F.col("w.relative_humidity_2m").alias("humidity_pct"),
        F.col("w.wind_speed_10m").alias("wind_kmh"),
        F.col("w.rain").alias("rain_mm"),
        F.col("w.weather_code").alias("weather_code"),
        F.col("a.european_aqi").alias("european_aqi"),
        F.col("a.pm2_5").alias("pm2_5"),
        F.col("a.pm10").alias("pm10"),
        F.col("a.ozone").alias("ozone"),
    )
