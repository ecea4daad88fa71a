"""The published tables: each job runs, writes its table and the table is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.score_queries import MART, mart_inputs
from acceptance.source_queries import BY_FEED_AND_AREA, SNAPSHOT, comparable, feed_time, land_json
from acceptance.spatial_queries import land_geojson
from acceptance.views import Inputs
from dwellrank import schemas
from dwellrank.plans.connectivity import connectivity_scores
from dwellrank.plans.events import events_by_category, events_scores
from dwellrank.plans.geometry import area_geometry
from dwellrank.plans.listings import value_scores
from dwellrank.plans.mart import mart_checks, stay_score_mart
from dwellrank.plans.punctuality import area_punctuality, city_counters, city_snapshots
from dwellrank.session import pin, scratch_path
from dwellrank.sources import sinks
from dwellrank.sources.documents import flatten_events, merge_conditions, read_event_search
from dwellrank.sources.feed import read_feed, stop_updates
from dwellrank.sources.files import read_csv, read_geojson


def published(df: DataFrame, label: str) -> DataFrame:
    """Replace the table of a job and read it back."""
    path = scratch_path(df.sparkSession, label)
    sinks.replace(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(df: DataFrame, label: str, schema, partition_by: str | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    sinks.append(df, path, schema, partition_by)
    return df.sparkSession.read.schema(schema).parquet(path)


@query("select * from v_connectivity")
def job_connectivity_score(t: Inputs) -> DataFrame:
    return published(connectivity_scores(t.stop_times, t.lookup, t.areas), "connectivity-score")


@query("select * from v_value")
def job_value_score(t: Inputs) -> DataFrame:
    return published(value_scores(t.listings), "value-score")


@query("select * from v_events_score")
def job_events_score(t: Inputs) -> DataFrame:
    return published(events_scores(t.points, t.districts), "events-score")


@query("""
    select neighbourhood, category, event_count,
           cast(sum(event_count) over (partition by neighbourhood) as bigint) as total_events from v_category_counts""")
def job_events_by_category(t: Inputs) -> DataFrame:
    return published(events_by_category(t.points, t.districts), "events-by-category")


@query("select * from v_listings")
def job_clean_listings(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "clean-listings")
    sinks.replace_csv(t.listings, path)
    return read_csv(t.spark, path, schemas.CLEAN_LISTINGS)


@query(SNAPSHOT)
def job_punctuality(t: Inputs) -> DataFrame:
    feed = read_feed(t.spark, land_json(t.feed, "feed"))
    return comparable(appended(city_snapshots(city_counters(feed), feed_time()), "punctuality", schemas.PUNCTUALITY))


@query(BY_FEED_AND_AREA.replace("select feed_timestamp,", "select feed_timestamp as snapshot_time,"))
def job_punctuality_by_area(t: Inputs) -> DataFrame:
    feed = read_feed(t.spark, land_json(t.feed, "feed"))
    rows = area_punctuality(stop_updates(feed), t.lookup, feed_time())
    return comparable(appended(rows, "area-punctuality", schemas.AREA_PUNCTUALITY))


@query("""
    select 1704067200::bigint as snapshot_time, temperature_c, humidity_pct, wind_kmh, rain_mm, weather_code,
           european_aqi, pm2_5, pm10, ozone from v_conditions""")
def job_conditions(t: Inputs) -> DataFrame:
    rows = merge_conditions(t.weather, t.air_quality, F.timestamp_seconds(F.lit(1704067200)))
    return comparable(appended(rows, "conditions", schemas.CONDITIONS))


@query("""
    select neighbourhood, shape < 4 as has_geometry, geometry_wkt from v_parcel_wkt""")
def job_area_geometry(t: Inputs) -> DataFrame:
    features = read_geojson(t.spark, land_geojson(t.parcels, "c_custkey"), multiline=False)
    table = published(area_geometry(features), "area-geometry")
    return table.select("neighbourhood", F.col("geometry").isNotNull().alias("has_geometry"), "geometry_wkt")


@query(MART)
def job_stay_score(t: Inputs) -> DataFrame:
    return published(stay_score_mart(*mart_inputs(t)), "stay-score")


@query("select name, day as date, venue, latitude, longitude, category from v_flat_events")
def job_raw_events(t: Inputs) -> DataFrame:
    events = flatten_events(read_event_search(t.spark, land_json(t.event_documents, "event-search")))
    path = scratch_path(t.spark, "raw-events")
    sinks.replace_csv(events, path)
    stored = read_csv(t.spark, path, schemas.EVENTS)
    return stored.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(SNAPSHOT)
def series_rerun(t: Inputs) -> DataFrame:
    """The series after commits of one half of the feeds, of all, and of all once more."""
    rows = city_snapshots(city_counters(read_feed(t.spark, land_json(t.feed, "feed"))), feed_time())
    path, day = scratch_path(t.spark, "series"), F.date_from_unix_date(F.floor(F.col("feed_timestamp") / 86400).cast("int"))
    for part in (rows.filter(F.col("feed_timestamp") / 86400 % 2 == 0), rows, rows):
        sinks.commit_series(part, path, schemas.PUNCTUALITY, ["feed_timestamp"], day)
    return comparable(sinks.read_series(t.spark, path, schemas.PUNCTUALITY))


@query("select * from v_conditions")
def series_rerun_conditions(t: Inputs) -> DataFrame:
    """The conditions of all places, committed twice, by place and time."""
    rows = merge_conditions(t.weather, t.air_quality)
    path = scratch_path(t.spark, "conditions-series")
    for _ in range(2):
        sinks.commit_series(rows, path, schemas.CONDITIONS_KEYED, ["location", "observed"], F.col("observed"))
    return sinks.read_series(t.spark, path, schemas.CONDITIONS_KEYED).drop("snapshot_time")


@query(MART)
def publish_after_checks(t: Inputs) -> DataFrame:
    """The published mart after a second one with doubled areas failed its checks: table and folder are as they were."""
    mart = pin(stay_score_mart(*mart_inputs(t)), "mart")
    path = scratch_path(t.spark, "published-mart")
    table = f"mart_{path[-32:]}"
    sinks.publish(mart, mart_checks, path, table)
    try:
        sinks.publish(mart.unionByName(mart), mart_checks, path, table)
    except sinks.ChecksFailed:
        stored = pin(t.spark.table(table), "mart-table")
        sinks.drop_table(t.spark, table)
        both = stored.intersect(t.spark.read.schema(mart.schema).parquet(path))
        return both.select(*mart.columns)
    raise AssertionError("a mart with doubled areas was published")


@query("select * from v_value")
def sink_catalog_table(t: Inputs) -> DataFrame:
    """A score table published in the catalog, replaced by itself, read back, and dropped."""
    scores = pin(value_scores(t.listings), "value")
    table = f"value_{scratch_path(t.spark, 'x')[-32:]}"
    for _ in range(2):
        sinks.publish(scores, table=table)
    stored = pin(t.spark.table(table), "value-table")
    sinks.drop_table(t.spark, table)
    return stored
