"""The ranked mart and the dashboard tables built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.constants import (
    AREA_TYPES,
    BALANCED,
    BUDGET,
    DEFAULT_WEIGHTS,
    HIDDEN_GEM,
    HIGH_PERCENTILE,
    LOW_PERCENTILE,
    PREMIUM,
)
from dwellrank.operators.checks import run_checks
from dwellrank.operators.ranking import (
    MAX_BROADCAST_VALUES,
    value_positions,
    with_ntile,
    with_percent_rank,
    with_rank,
)
from dwellrank.operators.scaling import blend, with_delta_from_mean
from dwellrank.session import pin


def area_type(value_percentile: Column, connectivity_percentile: Column) -> Column:
    """Label from the rounded percentiles; the first match wins."""
    cheap, dear = value_percentile >= HIGH_PERCENTILE, value_percentile < LOW_PERCENTILE
    linked, remote = connectivity_percentile >= HIGH_PERCENTILE, connectivity_percentile < LOW_PERCENTILE
    return (
        F.when(cheap & linked, HIDDEN_GEM).when(linked & dear, PREMIUM).when(cheap & remote, BUDGET).otherwise(BALANCED)
    )


def combined_scores(value: DataFrame, connectivity: DataFrame, events: DataFrame) -> DataFrame:
    """The three scores side by side, for areas with value and connectivity; no events score 0."""
    v = value.select("neighbourhood", F.col("value_score").cast("double").alias("value_score"))
    c = connectivity.select("neighbourhood", F.col("connectivity_score").cast("double").alias("connectivity_score"))
    e = events.select("neighbourhood", F.col("events_score").cast("double").alias("events_score"))
    both = v.join(c.filter(F.col("connectivity_score").isNotNull()), "neighbourhood")
    return both.join(e, "neighbourhood", "left").withColumn("events_score", F.coalesce("events_score", F.lit(0.0)))


def scored_areas(
    value: DataFrame, connectivity: DataFrame, events: DataFrame, weights: tuple[float, float, float] = DEFAULT_WEIGHTS
) -> DataFrame:
    """The combined scores with the weighted final score."""
    names = ("value_score", "connectivity_score", "events_score")
    return combined_scores(value, connectivity, events).withColumn("stay_score", blend(dict(zip(names, weights))))


def analysed_areas(scored: DataFrame) -> DataFrame:
    """Ranks, percentiles, quartiles and distances from the mean.

    The quartiles pin the scored areas, so the inputs are read once and all else reads the pinned rows.
    """
    best_first = [F.col("stay_score").desc(), F.col("neighbourhood").asc()]
    areas = with_ntile(scored, 4, best_first, "stay_quartile")
    areas = with_delta_from_mean(areas, {"connectivity_score": "connectivity_vs_avg", "value_score": "value_vs_avg"})
    positions = value_positions(areas, ["stay_score", "value_score", "connectivity_score"])

    def settled(df: DataFrame) -> DataFrame:
        # Only the join that splits hot values reads its input twice.
        return pin(df, "ranked") if positions.n_values > MAX_BROADCAST_VALUES else df

    ranked = settled(with_rank(areas, "stay_score", "overall_rank", positions=positions))
    ranked = settled(with_percent_rank(ranked, "value_score", "value_percentile", positions=positions))
    return settled(with_percent_rank(ranked, "connectivity_score", "connectivity_percentile", positions=positions))


MART_COLUMNS = (
    "neighbourhood",
    "value_score",
    "connectivity_score",
    "events_score",
    "stay_score",
    "overall_rank",
    "value_percentile",
    "connectivity_percentile",
    "stay_quartile",
    "connectivity_vs_avg",
    "value_vs_avg",
    "neighbourhood_type",
)


def stay_score_mart(
    value: DataFrame, connectivity: DataFrame, events: DataFrame, weights: tuple[float, float, float] = DEFAULT_WEIGHTS
) -> DataFrame:
    """The published mart, best area first."""
    analysed = analysed_areas(scored_areas(value, connectivity, events, weights))
    label = area_type(F.col("value_percentile"), F.col("connectivity_percentile"))
    return (
        analysed.withColumn("neighbourhood_type", label)
        .select(*MART_COLUMNS)
        .orderBy(F.col("stay_score").desc(), "neighbourhood")
    )


def mart_checks(mart: DataFrame) -> DataFrame:
    """Failure counts of the mart's contract: unique key, no nulls, known labels."""
    return run_checks(
        mart,
        unique=("neighbourhood",),
        not_null=("neighbourhood", "stay_score", "neighbourhood_type"),
        accepted={"neighbourhood_type": AREA_TYPES},
    )


def _score_checks(score: str):
    def checks(scores: DataFrame) -> DataFrame:
        return run_checks(scores, unique=("neighbourhood",)).unionByName(
            scores.agg(F.count_if(~F.col(score).between(0, 100)).alias("failures")).select(
                F.lit("in_range").alias("check"), F.lit(score).alias("column"), "failures"
            )
        )

    checks.__doc__ = f"Failure counts of a score table: one row per area, {score} from 0 to 100 or null."
    return checks


value_checks = _score_checks("value_score")
connectivity_checks = _score_checks("connectivity_score")
events_checks = _score_checks("events_score")


def area_type_counts(mart: DataFrame) -> DataFrame:
    return mart.groupBy("neighbourhood_type").agg(F.count("*").alias("areas"))


def ranked_detail(mart: DataFrame, value: DataFrame) -> DataFrame:
    """The ranked table with listing counts and prices."""
    prices = value.select("neighbourhood", "num_listings", "median_price")
    return (
        mart.join(prices, "neighbourhood")
        .select(
            "neighbourhood",
            "overall_rank",
            "stay_score",
            "value_score",
            "connectivity_score",
            "median_price",
            "num_listings",
            "neighbourhood_type",
        )
        .orderBy("overall_rank", "neighbourhood")
    )


def price_map(value: DataFrame, geometry: DataFrame) -> DataFrame:
    """Median price beside the geometry of each area."""
    return value.select("neighbourhood", "num_listings", "median_price").join(
        geometry.select("neighbourhood", "geometry_wkt"), "neighbourhood"
    )


def headline_figures(spark: SparkSession, listings: DataFrame, counters: DataFrame, events: DataFrame, today: Column) -> DataFrame:
    """One row: listings, mean nightly price, share of updates on time, upcoming events.

    Each figure is a one-row aggregate read as a scalar subquery.
    """
    home = listings.agg(
        F.struct(
            F.count("*").alias("n"),
            F.round(F.try_divide(F.sum(F.round(F.col("price") * 100).cast("long")), F.count("price")) / 100, 2).alias("price"),
        ).alias("v")
    ).scalar()
    punctual = counters.agg(F.round(F.try_divide(F.sum("on_time") * 100, F.sum("updates")), 1).alias("v")).scalar()
    upcoming = events.filter(F.col("date") >= today).agg(F.count("*").alias("v")).scalar()
    return spark.range(1).select(
        home["n"].alias("active_listings"),
        home["price"].alias("avg_nightly_price"),
        punctual.alias("pct_on_time"),
        upcoming.alias("upcoming_events"),
    )
