"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app_name: str = "dwellrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, when that setting is absent:
    on a cluster executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/dwellrank/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` once to the scratch folder and return it as a table scan.

    Used for small aggregates that several expressions read, so that the facts behind them are
    scanned once, and for frames whose partition numbers must not change on a retry. The table
    outlives lost executors and gives the optimizer true sizes for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin_measured(df: DataFrame, label: str = "pinned", **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """``pin`` and aggregates counted during the write, such as the number of rows; none is 0."""
    observation = Observation(label)
    pinned = pin(df.observe(observation, *[column.alias(name) for name, column in metrics.items()]), label)
    return pinned, {name: value or 0 for name, value in observation.get.items()}


def run_together(spark: SparkSession, *jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run functions that start Spark jobs at the same time, so that one fills the gaps of another."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [future.result() for future in futures]
