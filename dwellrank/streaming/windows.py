"""Tumbling windows by the time of the message header, with late updates kept aside.

Spark drops rows behind the watermark; here they are rows of a table of their own. Every micro-batch adds
three partitions under the output folder, which a batch run again replaces: ``counters`` per window, the ``late``
updates, and its ``marks``, the latest time it saw. The watermark of a batch comes from the marks of those before it,
so it is the same whenever the batch is run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.functions.scalars import is_on_time, usable_delay
from dwellrank.session import pin
from dwellrank.sources.feed import stop_updates, stream_feed
from dwellrank.streaming.punctuality import _write_batch

_COUNTERS = "window_start timestamp, window_end timestamp, updates bigint, on_time bigint, delay_sum bigint, batch_id bigint"
_LATE = "feed_timestamp bigint, stop_id string, delay int, event_time timestamp, batch_id bigint"
_MARKS = "latest timestamp, batch_id bigint"


def _watermark(spark: SparkSession, out: str, batch_id: int, lateness: Column) -> DataFrame:
    """One row: how far the batches before this one had come, less the lateness."""
    marks = spark.read.schema(_MARKS).parquet(f"{out}/marks").filter(F.col("batch_id") < batch_id)
    return marks.agg((F.max("latest") - lateness).alias("watermark"))


def run_windows(
    spark: SparkSession, feed_path: str, checkpoint: str, out: str, window: str = "1 day", lateness: str = "1 hour",
    max_files: int | None = None,
) -> None:
    """Count all landed messages not yet seen into windows under ``out``, then stop.

    An update whose window had ended at the watermark when its batch began is late: it changes no window and is
    kept in ``late``.
    """
    allowed = F.expr(f"interval {lateness}")

    def write(batch: DataFrame, batch_id: int) -> None:
        timed = stop_updates(batch).withColumn("event_time", F.timestamp_seconds("feed_timestamp"))
        updates = pin(timed.withColumn("w", F.window("event_time", window)), "window-updates")
        mark = _watermark(spark, out, batch_id, allowed).first().watermark
        late = F.col("w.end") <= F.lit(mark) if mark is not None else F.lit(False)
        delay = F.col("delay")
        counters = (
            updates.filter(~late & usable_delay(delay))
            .groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
            .agg(F.count("*").alias("updates"), F.count_if(is_on_time(delay)).alias("on_time"), F.sum(delay.cast("long")).alias("delay_sum"))
        )
        _write_batch(counters, batch_id, f"{out}/counters")
        _write_batch(updates.filter(late).drop("w"), batch_id, f"{out}/late")
        # Last, as the mark says that the batch is whole.
        _write_batch(updates.agg(F.max("event_time").alias("latest")), batch_id, f"{out}/marks")

    # Empty tables, so that they can be read before the first batch.
    for name, schema in (("counters", _COUNTERS), ("late", _LATE), ("marks", _MARKS)):
        spark.createDataFrame([], schema).write.mode("append").partitionBy("batch_id").parquet(f"{out}/{name}")
    query = (
        stream_feed(spark, feed_path, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_windows(spark: SparkSession, out: str, lateness: str = "1 hour") -> DataFrame:
    """Every window with its updates, share on time and mean delay, and whether it is closed: no update changes it."""
    merged = spark.read.schema(_COUNTERS).parquet(f"{out}/counters").groupBy("window_start", "window_end").agg(
        *[F.sum(c).alias(c) for c in ("updates", "on_time", "delay_sum")]
    )
    mark = spark.read.schema(_MARKS).parquet(f"{out}/marks").agg((F.max("latest") - F.expr(f"interval {lateness}")).alias("w")).scalar()
    return merged.select(
        "window_start",
        "updates",
        F.round(F.try_divide(F.col("on_time") * 100, F.col("updates")), 1).alias("pct_on_time"),
        F.round(F.try_divide(F.col("delay_sum"), F.col("updates")), 1).alias("avg_delay_seconds"),
        F.coalesce(F.col("window_end") <= mark, F.lit(False)).alias("closed"),
    )


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """The updates that came behind the watermark, with the batch they came in."""
    return spark.read.schema(_LATE).parquet(f"{out}/late")
