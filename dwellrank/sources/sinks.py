"""Writers: replace, append, keyed series, checked publishing, delimited text, and counts taken during the write."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellrank.session import pin, pin_measured


def replace(df: DataFrame, path: str) -> None:
    """Write a directory table, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a catalog table, replacing what is there; ``path`` keeps its files outside the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a staging table if it exists."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the declared columns, in order and with the declared types."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def append(df: DataFrame, path: str, schema: str, partition_by: str | None = None) -> None:
    """Append rows with a declared schema to a directory table."""
    writer = conform(df, schema).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


PART = "part"  # the partition column of a keyed series


def read_series(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a keyed series, each key once."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    return spark.read.schema(schema + f", {PART} string").parquet(path).select(*names)


def _arrived(df: DataFrame, path: str, schema: str, keys: list[str], part: Column) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows of ``df`` as a table, one per key, and what the series holds in the partitions they lie in."""
    spark = df.sparkSession
    full = schema + f", {PART} string"
    # An empty commit lays the folder, so the series can be read before its first row.
    spark.createDataFrame([], full).write.mode("append").partitionBy(PART).parquet(path)
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    rest = [c for c in names if c not in keys]
    one = conform(df.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none"))), full)
    one = one.groupBy(*keys, PART).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, PART, "_row.*")
    arrived = pin(one.select(*names, PART), "series-arrived")
    touched = F.broadcast(arrived.select(PART).distinct())  # one row per partition that the commit meets
    return arrived, spark.read.schema(full).parquet(path).join(touched, PART, "left_semi").select(*names, PART), names


def _without_keys(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose key is not among those of ``others``; null keys are keys like any other."""
    named = others.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return rows.join(named, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")


def _replace_parts(whole: DataFrame, path: str) -> None:
    """Put whole partitions in place of those of the series; what they hold is written aside first, as it is read from there."""
    pin(whole, "series-whole").hint("rebalance", PART).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(PART).parquet(path)


def commit_series(df: DataFrame, path: str, schema: str, keys: list[str], part: Column) -> int:
    """Add the rows of ``df`` whose key a series does not hold yet; gives their number.

    Run again with the same rows, as after a failure, it adds nothing: the first row of a key stays, and a
    write that broke off is made whole. ``part`` is computed from the keys alone, such as a day, and names the
    partition a key lies in. Only partitions with new rows are read and replaced, each as a whole, so readers
    never see a part of a commit twice. Of rows of ``df`` with one key the smallest is taken; null keys are
    keys like any other, and a null part is the partition ``none``.
    """
    arrived, stored, names = _arrived(df, path, schema, keys, part)
    fresh, counted = pin_measured(_without_keys(arrived, stored, keys), "series-fresh", n=F.count(F.lit(1)))
    if counted["n"]:
        changed = F.broadcast(fresh.select(PART).distinct())
        _replace_parts(stored.join(changed, PART, "left_semi").select(*names, PART).unionByName(fresh), path)
    return counted["n"]


def merge_series(df: DataFrame, path: str, schema: str, keys: list[str], part: Column) -> None:
    """Put the rows of ``df`` into a series, in place of those of the same keys; ``part`` as in ``commit_series``."""
    arrived, stored, _ = _arrived(df, path, schema, keys, part)
    _replace_parts(_without_keys(stored, arrived, keys).unionByName(arrived), path)


class ChecksFailed(Exception):
    """Checks of a staged table found failures; what was published before is untouched."""

    def __init__(self, failures: list):
        super().__init__(f"checks failed: {failures}")
        self.failures = failures


def publish(
    df: DataFrame, check: Callable[[DataFrame], DataFrame] | None = None, path: str | None = None, table: str | None = None,
    metrics: dict[str, Column] | None = None,
) -> dict:
    """Stage ``df``, check the staged rows, and only then replace a directory table, a catalog table, or both.

    The staging table lies in the catalog's warehouse and is dropped in any case. ``check`` gives rows with
    ``failures``; any above 0 raises ``ChecksFailed`` before anything published is touched. A catalog table is
    swapped by name: the staged rows are written to a second table, which takes the place of the old one by two
    renames. ``metrics`` are counted while staging and returned.
    """
    spark = df.sparkSession
    staging = f"staging_{uuid.uuid4().hex}"
    observation = Observation("publish")
    counted = df.observe(observation, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
    try:
        counted.write.saveAsTable(staging)
        staged = spark.table(staging)
        failures = check(staged).filter(F.col("failures") > 0).collect() if check else []
        if failures:
            raise ChecksFailed([tuple(r) for r in failures])
        if path:
            replace(staged, path)
        if table:
            _swap(spark, staged, table)
    finally:
        drop_table(spark, staging)
    return observation.get if metrics else {}


def _swap(spark: SparkSession, staged: DataFrame, table: str) -> None:
    incoming, old = f"{table}__incoming", f"{table}__replaced"
    for leftover in (incoming, old):
        drop_table(spark, leftover)
    staged.write.saveAsTable(incoming)
    if spark.catalog.tableExists(table):
        _rename(spark, table, old)
    _rename(spark, incoming, table)
    drop_table(spark, old)


def _rename(spark: SparkSession, table: str, to: str) -> None:
    spark.sql("ALTER TABLE IDENTIFIER(:old) RENAME TO IDENTIFIER(:new)", args={"old": table, "new": to})


def replace_csv(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """Write delimited files with a header line; quotes in text are doubled."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("quoteAll", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def replace_with_metrics(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict:
    """Replace a directory table and return metrics counted in the same pass."""
    observation = Observation("write-metrics")
    replace(df.observe(observation, *[column.alias(name) for name, column in metrics.items()]), path)
    return observation.get
