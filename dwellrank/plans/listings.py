"""Listing cleaning and the value score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.constants import LISTING_COLUMNS, MIN_LISTINGS
from dwellrank.functions.scalars import money, plausible_price
from dwellrank.operators.medians import count_and_lower_median, price_counts
from dwellrank.operators.scaling import score_table


def clean_listings(raw: DataFrame) -> DataFrame:
    """The kept columns, with the price as a number; implausible prices become null, rows stay."""
    parsed = raw.select(*LISTING_COLUMNS).withColumn("price", money(F.col("price")))
    return parsed.withColumn("price", plausible_price(F.col("price")))


def listing_summary(clean: DataFrame) -> DataFrame:
    """One row: listings, priced listings and distinct areas."""
    return clean.agg(
        F.count("*").alias("listings"),
        F.count("price").alias("priced_listings"),
        F.count_distinct("neighbourhood_cleansed").alias("neighbourhoods"),
    )


def area_prices(clean: DataFrame, min_listings: int = MIN_LISTINGS) -> DataFrame:
    """Priced listings and median price of the areas with enough of them."""
    priced = clean.select(F.col("neighbourhood_cleansed").alias("neighbourhood"), F.col("price").try_cast("double").alias("price"))
    return count_and_lower_median(priced, "neighbourhood", "price").filter(F.col("num_listings") >= min_listings)


def value_scores(clean: DataFrame, min_listings: int = MIN_LISTINGS) -> DataFrame:
    """Value score per area: 100 for the lowest median price, 0 for the highest."""
    return score_table(area_prices(clean, min_listings), {"median_price": "value_score"}, invert=True)


def room_type_breakdown(clean: DataFrame) -> DataFrame:
    """Priced listings with mean and median price per room type."""
    counts = price_counts(clean, ["room_type"], "price")
    cents = F.round(F.col("price") * 100).cast("long") * F.col("n")
    return counts.groupBy("room_type").agg(
        F.sum("n").alias("num_listings"),
        F.round(F.try_divide(F.sum(cents), F.sum("n")) / 100, 2).alias("avg_price"),
        F.round(F.percentile("price", 0.5, F.col("n")), 2).alias("median_price"),
    ).filter(F.col("num_listings") > 0)
