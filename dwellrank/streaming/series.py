"""The city's punctuality as a stream with state: counters per feed live in the state store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank import schemas
from dwellrank.plans.punctuality import _delay_counters, city_snapshots
from dwellrank.sources import sinks
from dwellrank.sources.feed import entity_updates, stream_feed


def feed_counters(messages: DataFrame, lateness: str) -> DataFrame:
    """Counters per feed of a stream, kept until the watermark passes the feed.

    The time of a feed is that of its header; parts of a feed that come more than ``lateness`` after the latest
    one are left out.
    """
    timed = entity_updates(messages).withColumn("feed_time", F.timestamp_seconds("feed_timestamp"))
    return timed.withWatermark("feed_time", lateness).groupBy("feed_time", "feed_timestamp").agg(
        F.count_if("first_of_entity").alias("active_trips"), *_delay_counters()
    )


def run_series(
    spark: SparkSession,
    feed_path: str,
    checkpoint: str,
    series_path: str,
    snapshot_time: Column | None = None,
    lateness: str = "7 days",
    max_files: int | None = None,
) -> None:
    """Bring the city series up to date with all landed messages not yet seen, then stop.

    Each micro-batch changes the state of the feeds it has messages of, and only their rows of the series are
    written: a row holds the feed's whole counters, so a batch run again writes the same row. The state outlives the
    run in ``checkpoint``; a feed may arrive in any number of files, batches and runs.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        rows = city_snapshots(changed.drop("feed_time"), snapshot_time)
        day = F.date_from_unix_date(F.floor(F.col("feed_timestamp") / 86400).cast("int"))
        sinks.merge_series(rows, series_path, schemas.PUNCTUALITY, ["feed_timestamp"], day)

    query = (
        feed_counters(stream_feed(spark, feed_path, max_files), lateness)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
