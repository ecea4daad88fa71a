"""Exact medians over values that repeat a lot, such as prices in cents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def price_counts(df: DataFrame, keys: list[str], price: str) -> DataFrame:
    """Listings per key and price in cents.

    Cleaned prices lie in a fixed range, so a key has at most one row per cent of that range however
    many listings it holds; most of the reduction happens before the shuffle. Rounding to cents first
    does not change a lower median that is itself rounded to cents. Missing prices stay as a group
    that counts 0: filtering them would make the optimizer parse every price again in the filter.
    """
    return df.groupBy(*keys, F.round(price, 2).alias("price")).agg(F.count(price).alias("n"))


def count_and_lower_median(df: DataFrame, key: str, price: str) -> DataFrame:
    """``num_listings`` and ``median_price`` (a price that occurs, never a mean of two) per key.

    Keys without any price are left out.
    """
    up_to = Window.partitionBy(key).orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    counted = price_counts(df, [key], price).select(
        key,
        "price",
        "n",
        F.sum("n").over(up_to).alias("n_up_to"),
        F.sum("n").over(Window.partitionBy(key)).alias("n_all"),
    )
    return counted.groupBy(key).agg(
        F.sum("n").alias("num_listings"),
        F.min(F.when(F.col("n_up_to") * 2 >= F.col("n_all"), F.col("price"))).alias("median_price"),
    ).filter(F.col("num_listings") > 0)


def interpolated_median(df: DataFrame, price: str, name: str) -> DataFrame:
    """One row: the median of all prices, the mean of the two middle ones when their count is even."""
    return price_counts(df, [], price).agg(F.round(F.percentile("price", 0.5, F.col("n")), 2).alias(name))
