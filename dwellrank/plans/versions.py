"""Lookups that change: stations with the area they belonged to at any time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.scalars import is_on_time, station_or_null, usable_delay
from dwellrank.operators.asof import asof_join
from dwellrank.operators.skew import MAX_BROADCAST_ROWS
from dwellrank.plans.punctuality import area_snapshots
from dwellrank.session import pin_measured

VERSIONS = "station string, neighbourhood string, valid_from timestamp, valid_to timestamp"


def next_versions(versions: DataFrame | None, stations: DataFrame, at: Column) -> DataFrame:
    """The versions after ``stations`` (station, neighbourhood, one row each) hold from ``at`` on.

    A station whose area is another one, or that is gone, has its open version closed at ``at``; what is new or
    changed gets a version from then on. Stations that stay as they are keep their version. Run again with the
    same lookup and time, nothing changes.
    """
    new = stations.select("station", F.col("neighbourhood").alias("now"), F.lit(True).alias("listed"))
    if versions is None:
        return new.select("station", F.col("now").alias("neighbourhood"), at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    closed = versions.filter(F.col("valid_to").isNotNull())
    met = versions.filter(F.col("valid_to").isNull()).withColumn("open", F.lit(True)).join(new, "station", "full")
    same = F.coalesce("open", F.lit(False)) & F.coalesce("listed", F.lit(False)) & F.col("neighbourhood").eqNullSafe(F.col("now"))
    kept = F.when(F.col("open"), F.struct("neighbourhood", "valid_from", F.when(~same, at).alias("valid_to")))
    opened = F.when(F.col("listed") & ~same, F.struct(F.col("now").alias("neighbourhood"), at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")))
    rows = F.explode(F.filter(F.array(kept, opened), lambda row: row.isNotNull()))
    return closed.unionByName(met.select("station", rows.alias("row")).select("station", "row.*"))


def _versioned(rows: DataFrame, versions: DataFrame, at: str, max_broadcast_rows: int) -> DataFrame:
    """``rows`` (station, ``at`` and others) with the area of their station at that time; rows without one drop out.

    Versions are counted: below the limit they are broadcast and no row of the other side moves. Beyond it the
    latest version up to each row's time is found in time ranges, which a station with most rows cannot crowd.
    """
    table, counted = pin_measured(versions, "versions", n=F.count(F.lit(1)))
    if counted["n"] <= max_broadcast_rows:
        within = (F.col("r.station") == F.col("v.station")) & (F.col(f"r.{at}") >= F.col("v.valid_from")) & (
            F.col("v.valid_to").isNull() | (F.col(f"r.{at}") < F.col("v.valid_to"))
        )
        met = rows.alias("r").join(F.broadcast(table.alias("v")), within).select("r.*", "v.neighbourhood")
    else:
        latest = table.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).withColumnRenamed("valid_from", at)
        found = asof_join(rows, latest, ["station"], at, how="inner")
        met = found.filter(F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))).select(*rows.columns, "neighbourhood")
    return met.filter(F.col("neighbourhood").isNotNull())


def area_punctuality_as_of(
    updates: DataFrame,
    versions: DataFrame,
    snapshot_time: Column | None = None,
    keys: tuple[str, ...] = ("feed_timestamp",),
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Punctuality per area (and feed), each update in the area that its station had at the time of its feed.

    Updates are counted per feed and station first, so a station with most of the updates is one row per feed.
    """
    delay = F.col("delay")
    per_station = (
        updates.filter(usable_delay(delay))
        .groupBy("feed_timestamp", station_or_null(F.col("stop_id")).alias("station"))
        .agg(F.count("*").alias("updates"), F.count_if(is_on_time(delay)).alias("on_time"), F.sum(delay.cast("long")).alias("delay_sum"))
        .withColumn("at", F.timestamp_seconds("feed_timestamp"))
    )
    joined = _versioned(per_station, versions, "at", max_broadcast_rows)
    return area_snapshots(joined.select(*keys, "neighbourhood", "updates", "on_time", "delay_sum"), snapshot_time, keys)
