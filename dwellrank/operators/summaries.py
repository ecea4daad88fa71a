"""Summaries that merge: distinct counts and quantiles of any range of snapshots, without their rows.

A snapshot is summarised once, in one pass, into a row of sketches of fixed size. Rows of any snapshots merge
into the summary of all their rows, in any order and number.

Bounds, each for at least 99 in 100 estimates: a distinct count is within ``DISTINCT_ERROR`` of the exact one, and
the rank of a quantile within ``RANK_ERROR`` of the number of values. Small counts are exact or nearly so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 14  # of a distinct sketch: 2**14 registers, a standard error of 0.65 %
DISTINCT_ERROR = 0.02
KEPT = 800  # items of a quantile sketch's top level
RANK_ERROR = 0.01


def summaries(df: DataFrame, by: list[str], distinct: list[str], measures: list[str]) -> DataFrame:
    """``by``, n_rows, and for each column ``<column>_distinct`` and ``<column>_quantiles``, as sketches.

    Tasks sketch what they read, so a snapshot with most of the rows is a few sketches before anything moves.
    Nulls are in no sketch; a column without any value has an empty distinct sketch and no quantile sketch.
    """
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *[F.hll_sketch_agg(c, LOG_REGISTERS).alias(f"{c}_distinct") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), KEPT).alias(f"{c}_quantiles") for c in measures],
    )


def merged_summaries(stored: DataFrame, by: list[str]) -> DataFrame:
    """The summaries of all rows with equal ``by`` as one, in the columns of ``summaries``."""
    out = [F.sum("n_rows").alias("n_rows")]
    for c in stored.columns:
        if c.endswith("_distinct"):
            out.append(F.hll_union_agg(c).alias(c))
        elif c.endswith("_quantiles"):
            out.append(F.kll_merge_agg_double(c).alias(c))
    return stored.groupBy(*by).agg(*out)


def read_summaries(merged: DataFrame, probabilities: list[float]) -> DataFrame:
    """The other columns with the estimates: ``<column>_distinct`` counts and ``<column>_quantiles`` lists."""
    out = []
    for c in merged.columns:
        if c.endswith("_distinct"):
            out.append(F.hll_sketch_estimate(c).alias(c))
        elif c.endswith("_quantiles"):
            out.append(F.array(*[F.kll_sketch_get_quantile_double(c, F.lit(p)) for p in probabilities]).alias(c))
        else:
            out.append(F.col(c))
    return merged.select(*out)
