"""Punctuality as streams over landed feed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.functions.scalars import is_on_time, usable_delay
from dwellrank.plans.punctuality import area_counters, area_snapshots, city_counters, city_snapshots
from dwellrank.sources.feed import stop_updates, stream_feed


SOURCE = ("source",)  # the landed file that a counter comes from


def _write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch as its own partition, replacing it when the batch is replayed."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def run_counters(
    spark: SparkSession,
    feed_path: str,
    checkpoint: str,
    city_path: str,
    area_path: str | None = None,
    stations: DataFrame | None = None,
    max_files: int | None = None,
) -> None:
    """Process every landed message not yet seen, then stop.

    Each micro-batch adds its counters, per landed file and feed to ``city_path`` and per file, feed and
    area to ``area_path``. Counters are sums, so a feed may arrive in several files and batches. A batch run
    again replaces its own rows, and since every row names its file, files that are counted again in other
    batches (after the stream's state was lost) count once. ``max_files`` bounds a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(city_counters(batch, SOURCE), batch_id, city_path)
        if area_path is not None:
            areas = area_counters(stop_updates(batch, SOURCE), stations, (*SOURCE, "feed_timestamp"))
            _write_batch(areas, batch_id, area_path)

    query = (
        stream_feed(spark, feed_path, max_files)
        .select("*", F.col("_metadata.file_path").alias("source"))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


_CITY = (
    "source string, feed_timestamp bigint, active_trips bigint, updates bigint, on_time bigint, late bigint, "
    "early bigint, delay_sum bigint, batch_id bigint"
)
_AREA = "source string, feed_timestamp bigint, neighbourhood string, updates bigint, on_time bigint, delay_sum bigint, batch_id bigint"


def read_city_snapshots(spark: SparkSession, city_path: str, snapshot_time: Column | None = None) -> DataFrame:
    """The city series: one row per feed from the counters of all files, each file once."""
    counters = spark.read.schema(_CITY).parquet(city_path).dropDuplicates(["source", "feed_timestamp"])
    return city_snapshots(counters.drop("batch_id", "source"), snapshot_time)


def read_area_snapshots(
    spark: SparkSession, area_path: str, snapshot_time: Column | None = None, keys: tuple[str, ...] = ("feed_timestamp",)
) -> DataFrame:
    """The area series, per feed or (with no keys) over all feeds."""
    counters = spark.read.schema(_AREA).parquet(area_path)
    counters = counters.dropDuplicates(["source", "feed_timestamp", "neighbourhood"]).drop("batch_id", "source")
    if not keys:
        counters = counters.drop("feed_timestamp")
    return area_snapshots(counters, snapshot_time, keys)


def windowed_punctuality(updates: DataFrame, time_column: str, window: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Usable updates, share on time and mean delay per tumbling event-time window.

    Rows later than the watermark are dropped; in append mode a window is emitted once it is closed.
    """
    delay = F.col("delay")
    return (
        updates.withWatermark(time_column, lateness)
        .filter(usable_delay(delay))
        .groupBy(F.window(time_column, window).alias("window"))
        .agg(
            F.count("*").alias("updates"),
            F.count_if(is_on_time(delay)).alias("on_time"),
            F.sum(delay.cast("long")).alias("delay_sum"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "updates",
            F.round(F.try_divide(F.col("on_time") * 100, F.col("updates")), 1).alias("pct_on_time"),
            F.round(F.try_divide(F.col("delay_sum"), F.col("updates")), 1).alias("avg_delay_seconds"),
        )
    )


def append_stream(df: DataFrame, path: str, checkpoint: str) -> None:
    """Write what is available of a stream to a directory table, exactly once, then stop."""
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
