"""Run acceptance queries beside their SQL twins: ``python -m acceptance.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from acceptance.catalog import ORACLES, QUERIES
from dwellrank.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def canonical(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; numbers compare by value, not by type."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float) and math.isnan(v):
            return "NaN"
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return v
        if isinstance(v, (int, float)):
            return float(v)
        return str(v)

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """None when Spark and SQL agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    spark_rows = canonical(frame.columns, frame.collect())
    result = connection.execute(ORACLES[name])
    sql_columns = [c[0] for c in result.description]
    if sorted(frame.columns) != sorted(sql_columns):
        return f"columns {sorted(frame.columns)} != {sorted(sql_columns)}"
    sql_rows = canonical(sql_columns, result.fetchall())
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)} rows"
    unequal = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if unequal:
        return f"{len(unequal)} of {len(sql_rows)} rows differ, first: {unequal[0]}"
    kinds = {str(c[1]) for c in result.description if "HUGEINT" in str(c[1])}
    return f"SQL type {kinds}" if kinds else None


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, connection, folder, name) if name in ORACLES else None
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
