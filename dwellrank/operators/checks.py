"""Data checks that return the failing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts; nulls are not checked."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their counts; nulls pass."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n_rows"))


def run_checks(
    df: DataFrame,
    unique: tuple[str, ...] = (),
    not_null: tuple[str, ...] = (),
    accepted: dict[str, tuple] | None = None,
) -> DataFrame:
    """Failures per check as ``(check, column, failures)``; all row checks share one pass."""
    counters: dict[tuple[str, str], Column] = {}
    for column in not_null:
        counters[("not_null", column)] = F.count_if(F.col(column).isNull())
    for column, values in (accepted or {}).items():
        counters[("accepted_values", column)] = F.count_if(~F.col(column).isin(*values))
    frames = []
    if counters:
        rows = F.array(
            *[
                F.struct(F.lit(kind).alias("check"), F.lit(column).alias("column"), counter.alias("failures"))
                for (kind, column), counter in counters.items()
            ]
        )
        frames.append(df.agg(rows.alias("rows")).select(F.inline("rows")))
    for column in unique:
        frames.append(
            failing_unique(df, column)
            .agg(F.count("*").alias("failures"))
            .select(F.lit("unique").alias("check"), F.lit(column).alias("column"), "failures")
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
