"""Scores on a 0 to 100 scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.scalars import exact_mean
from dwellrank.session import pin


def with_minmax_scores(df: DataFrame, columns: dict[str, str], invert: bool = False) -> DataFrame:
    """Add ``{column: score}`` min-max scores, rounded to one digit; ``invert`` makes low values high.

    All extremes come from one aggregate, read as a scalar subquery: no driver round trip, no join
    and no single-partition window. ``df`` is read twice, so it should be a scan or pinned.
    A column whose values are all equal scores null.
    """
    extremes = df.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_lo") for c in columns],
            *[F.max(c).alias(f"{c}_hi") for c in columns],
        ).alias("extremes")
    ).scalar()

    def score(column: str) -> Column:
        low, high = extremes[f"{column}_lo"], extremes[f"{column}_hi"]
        share = F.try_divide(F.col(column) - low, high - low) * 100
        return F.round(100 - share if invert else share, 1)

    return df.withColumns({name: score(column) for column, name in columns.items()})


def mean_score(*scores: str) -> Column:
    """Mean of scores that are already rounded, rounded again to one digit."""
    total = sum((F.col(s) for s in scores[1:]), F.col(scores[0]))
    return F.round(total / len(scores), 1)


def blend(weights: dict[str, float]) -> Column:
    """Weighted sum of score columns, rounded to one digit; zero weights are left out."""
    terms = [F.col(name) * F.lit(weight) for name, weight in weights.items() if weight]
    return F.round(sum(terms[1:], terms[0]), 1)


def with_delta_from_mean(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``{column: delta}`` differences from the overall mean, rounded to one digit."""
    means = df.agg(F.struct(*[exact_mean(F.col(c)).alias(c) for c in columns]).alias("means")).scalar()
    return df.withColumns({name: F.round(F.col(c) - means[c], 1) for c, name in columns.items()})


def score_table(df: DataFrame, columns: dict[str, str], invert: bool = False) -> DataFrame:
    """Min-max scores of an aggregate: it is pinned first, so the facts are scanned once."""
    return with_minmax_scores(pin(df, "score-input"), columns, invert)
