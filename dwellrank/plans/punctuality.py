"""Punctuality from the live feed.

Snapshots are built in two steps: mergeable counters (sums only), then shares and means from the
merged counters. Batch and streaming jobs use the same steps, so a feed split over several messages,
files or micro-batches gives the same snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.scalars import (
    floor_minutes,
    is_early,
    is_late,
    is_on_time,
    station_or_null,
    usable_delay,
)
from dwellrank.operators.joins import station_areas
from dwellrank.operators.skew import join_lookup
from dwellrank.sources.feed import entity_updates


def _delay_counters() -> list[Column]:
    delay = F.col("delay")
    kept = usable_delay(delay)
    return [
        F.count_if(kept).alias("updates"),
        F.count_if(kept & is_on_time(delay)).alias("on_time"),
        F.count_if(kept & is_late(delay)).alias("late"),
        F.count_if(kept & is_early(delay)).alias("early"),
        F.coalesce(F.sum(F.when(kept, delay.cast("long"))), F.lit(0)).alias("delay_sum"),
    ]


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def _share(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part) * 100, F.col(whole)), 1)


def _mean(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.col(total), F.col(count)), 1)


def city_counters(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counters per feed (and ``keep``); a feed without any usable delay still gives a row."""
    return entity_updates(messages, keep).groupBy(*keep, "feed_timestamp").agg(
        F.count_if("first_of_entity").alias("active_trips"), *_delay_counters()
    )


def city_snapshots(counters: DataFrame, snapshot_time: Column | None = None) -> DataFrame:
    """One punctuality row per feed from its counters; shares and means are 0 without updates."""
    merged = _merged(counters, ["feed_timestamp"])
    return merged.select(
        (snapshot_time if snapshot_time is not None else F.current_timestamp()).alias("snapshot_time"),
        "feed_timestamp",
        "active_trips",
        F.col("updates").alias("total_stop_updates"),
        "on_time",
        "late",
        "early",
        F.coalesce(_share("on_time", "updates"), F.lit(0.0)).alias("pct_on_time"),
        F.coalesce(_mean("delay_sum", "updates"), F.lit(0.0)).alias("avg_delay_seconds"),
    )


def area_counters(updates: DataFrame, stations: DataFrame, keys: tuple[str, ...] = ("feed_timestamp",)) -> DataFrame:
    """Counters per area. Updates are counted per station first, so only one row per station is joined;
    updates of unknown stations drop out.
    """
    per_station = (
        updates.filter(usable_delay(F.col("delay")))
        .groupBy(*keys, station_or_null(F.col("stop_id")).alias("station"))
        .agg(
            F.count("*").alias("updates"),
            F.count_if(is_on_time(F.col("delay"))).alias("on_time"),
            F.sum(F.col("delay").cast("long")).alias("delay_sum"),
        )
    )
    joined = per_station.join(stations, "station").filter(F.col("neighbourhood").isNotNull())
    return _merged(joined.drop("station"), [*keys, "neighbourhood"])


def area_snapshots(
    counters: DataFrame, snapshot_time: Column | None = None, keys: tuple[str, ...] = ("feed_timestamp",)
) -> DataFrame:
    """Punctuality per area from its counters."""
    merged = _merged(counters, [*keys, "neighbourhood"])
    return merged.select(
        *keys,
        "neighbourhood",
        "updates",
        _share("on_time", "updates").alias("pct_on_time"),
        _mean("delay_sum", "updates").alias("avg_delay_seconds"),
        (snapshot_time if snapshot_time is not None else F.current_timestamp()).alias("snapshot_time"),
    )


def area_punctuality(
    updates: DataFrame,
    lookup: DataFrame,
    snapshot_time: Column | None = None,
    keys: tuple[str, ...] = ("feed_timestamp",),
) -> DataFrame:
    """Punctuality per area (and feed) straight from stop updates and the stop lookup."""
    return area_snapshots(area_counters(updates, station_areas(lookup), keys), snapshot_time, keys)


def delays_with_area(updates: DataFrame, lookup: DataFrame) -> DataFrame:
    """Every stop update with the area of its station; unknown stations drop out."""
    keyed = updates.withColumn("station", station_or_null(F.col("stop_id")))
    return join_lookup(keyed, station_areas(lookup), "station")


def feed_profile(messages: DataFrame) -> DataFrame:
    """One row per feed: entities, trip updates, vehicles, delays, extremes in whole minutes."""
    delay = F.col("delay")
    first = F.col("first_of_entity")
    return entity_updates(messages).groupBy("feed_timestamp").agg(
        F.count_if(first).alias("entities"),
        F.count_if(first & F.col("has_trip_update")).alias("trip_updates"),
        F.count_if(first & F.col("has_vehicle")).alias("vehicles"),
        F.count(delay).alias("delays"),
        F.count_if(is_on_time(delay)).alias("on_time"),
        F.count_if(is_late(delay)).alias("late"),
        F.count_if(is_early(delay)).alias("early"),
        floor_minutes(F.max(delay)).alias("max_delay_min"),
        floor_minutes(F.min(delay)).alias("min_delay_min"),
    )
