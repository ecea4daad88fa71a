"""City events: where they are and how many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.constants import OTHER_CATEGORY
from dwellrank.operators.joins import attach_group_total
from dwellrank.operators.scaling import score_table
from dwellrank.operators.spatial import within_join


def event_spots(events: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Events counted per exact place: events at one venue make one point."""
    return (
        events.dropna(subset=["latitude", "longitude"])
        .groupBy("longitude", "latitude", *by)
        .agg(F.count("*").alias("n"))
    )


def area_event_counts(events: DataFrame, areas: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Events per area (and further columns); areas without events are absent."""
    hits = within_join(event_spots(events, by), areas.select("neighbourhood", "geometry"), "inner")
    return (
        hits.dropna(subset=["neighbourhood"])
        .groupBy("neighbourhood", *by)
        .agg(F.sum("n").alias("event_count"))
    )


def events_scores(events: DataFrame, areas: DataFrame) -> DataFrame:
    """Events score per area with events: 0 for the fewest, 100 for the most."""
    return score_table(area_event_counts(events, areas), {"event_count": "events_score"})


def with_category(events: DataFrame) -> DataFrame:
    return events.withColumn("category", F.coalesce("category", F.lit(OTHER_CATEGORY)))


def events_by_category(events: DataFrame, areas: DataFrame) -> DataFrame:
    """Events per area and category, with the area's total beside them."""
    counts = area_event_counts(with_category(events), areas, ("category",))
    return attach_group_total(counts, "neighbourhood", "event_count", "total_events")


def busiest(by_category: DataFrame, limit: int = 10) -> DataFrame:
    """The rows with the most events."""
    return by_category.orderBy(F.col("event_count").desc(), "neighbourhood", "category").limit(limit)
