"""Command line of the batch jobs: ``spark-submit dwellrank/jobs.py JOB --input NAME=PATH ... --output PATH``.

Each job reads declared inputs and replaces (or, for series, appends to) the directory table named by
``--output``. Scheduling is left to whatever submits the jobs.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank import schemas
from dwellrank.constants import MIN_LISTINGS
from dwellrank.operators.joins import station_areas
from dwellrank.plans.connectivity import connectivity_scores, departures_by_hour
from dwellrank.plans.events import events_by_category, events_scores
from dwellrank.plans.geometry import area_geometry, area_geometry_from_text, area_sizes, stop_lookup
from dwellrank.plans.listings import clean_listings, room_type_breakdown, value_scores
from dwellrank.plans.mart import (
    area_type_counts,
    connectivity_checks,
    events_checks,
    headline_figures,
    mart_checks,
    price_map,
    ranked_detail,
    stay_score_mart,
    value_checks,
)
from dwellrank.plans.punctuality import area_punctuality, city_counters, city_snapshots, feed_profile
from dwellrank.plans.versions import VERSIONS, area_punctuality_as_of, next_versions
from dwellrank.session import build_session, pin
from dwellrank.sources import sinks
from dwellrank.sources.documents import (
    flatten_events,
    merge_conditions,
    observation_time,
    read_air_quality,
    read_event_search,
    read_weather,
)
from dwellrank.sources.feed import read_feed, sample_updates, stop_updates
from dwellrank.sources.files import read_csv, read_geojson, read_multiline_csv
from dwellrank.streaming.punctuality import read_area_snapshots, read_city_snapshots, run_counters
from dwellrank.streaming.series import run_series
from dwellrank.streaming.windows import read_late, read_windows, run_windows

Paths = dict[str, str]


def _publish(df: DataFrame, output: str, args, check: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace a model's directory table, and its catalog table where ``--table`` names one, if its checks pass."""
    try:
        sinks.publish(df, check, output, args.table)
    except sinks.ChecksFailed as failed:
        raise SystemExit(f"{args.job} {failed}") from failed


def clean_listings_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    raw = read_multiline_csv(spark, paths["listings"], schemas.RAW_LISTINGS, args.partitions)
    sinks.replace_csv(clean_listings(raw), output)


def _clean(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_csv(spark, paths["listings"], schemas.CLEAN_LISTINGS)


def value_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(value_scores(_clean(spark, paths), args.min_listings), output, args, value_checks)


def room_types_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(room_type_breakdown(_clean(spark, paths)), output, args)


def _transit(spark: SparkSession, paths: Paths) -> tuple[DataFrame, DataFrame]:
    return (
        read_csv(spark, paths["stop_times"], schemas.STOP_TIMES),
        read_csv(spark, paths["lookup"], schemas.STOP_LOOKUP),
    )


def connectivity_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    areas = read_csv(spark, paths["areas"], schemas.AREA_SIZES)
    transform = "log1p" if args.log_density else None
    _publish(connectivity_scores(*_transit(spark, paths), areas, density_transform=transform), output, args, connectivity_checks)


def hours_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(departures_by_hour(*_transit(spark, paths)), output, args)


def raw_events_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    sinks.replace_csv(flatten_events(read_event_search(spark, paths["search"])), output)


def _areas(spark: SparkSession, paths: Paths, args) -> DataFrame:
    """Areas of GeoJSON documents; with ``--geojson-lines`` one document per line, in files that are split."""
    return read_geojson(spark, paths["geojson"], multiline=not args.geojson_lines)


def _events_and_areas(spark: SparkSession, paths: Paths, args) -> tuple[DataFrame, DataFrame]:
    # Names may hold line breaks.
    return read_multiline_csv(spark, paths["events"], schemas.EVENTS), _areas(spark, paths, args)


def events_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(events_scores(*_events_and_areas(spark, paths, args)), output, args, events_checks)


def categories_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(events_by_category(*_events_and_areas(spark, paths, args)), output, args)


def geometry_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(area_geometry(_areas(spark, paths, args)), output, args)


def geometry_text_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """Areas whose geometry is a text column; texts may hold line breaks."""
    sinks.replace(area_geometry_from_text(read_multiline_csv(spark, paths["areas"], schemas.AREA_TEXT, args.partitions)), output)


def area_sizes_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    sinks.replace_csv(area_sizes(_areas(spark, paths, args)), output)


def stop_lookup_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    stops = read_csv(spark, paths["stops"], schemas.STOPS)
    sinks.replace_csv(stop_lookup(stops, _areas(spark, paths, args)), output)


def _feed_day() -> Column:
    return F.date_from_unix_date(F.floor(F.col("feed_timestamp") / 86400).cast("int"))


def punctuality_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The city's punctuality per feed; a feed that the series holds is not added again."""
    rows = city_snapshots(city_counters(read_feed(spark, paths["feed"])))
    sinks.commit_series(rows, output, schemas.PUNCTUALITY, ["feed_timestamp"], _feed_day())


def area_punctuality_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    lookup = read_csv(spark, paths["lookup"], schemas.STOP_LOOKUP)
    rows = area_punctuality(stop_updates(read_feed(spark, paths["feed"])), lookup)
    sinks.commit_series(rows, output, schemas.AREA_PUNCTUALITY_KEYED, ["feed_timestamp", "neighbourhood"], _feed_day())


def punctuality_stream_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """Counters of all newly landed messages under ``output``: ``city``, ``area`` and the stream's state."""
    lookup = read_csv(spark, paths["lookup"], schemas.STOP_LOOKUP)
    stations = pin(station_areas(lookup), "stations")
    run_counters(spark, paths["feed"], f"{output}/state", f"{output}/city", f"{output}/area", stations, args.max_files)


def state_series_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The city series under ``output/series``, kept by a stream whose state lies in ``output/state``."""
    run_series(spark, paths["feed"], f"{output}/state", f"{output}/series", max_files=args.max_files)


def windows_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """Windows by header time and the late updates, under ``output``; the windows are published as ``output/windows``."""
    run_windows(spark, paths["feed"], f"{output}/state", output, args.window, args.lateness, args.max_files)
    sinks.replace(read_windows(spark, output, args.lateness), f"{output}/windows")
    print(f"late updates: {read_late(spark, output).count()}")


def lookup_versions_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The station versions after the lookup given; ``versions`` names those before it, if there are any."""
    before = spark.read.schema(VERSIONS).parquet(paths["versions"]) if "versions" in paths else None
    stations = station_areas(read_csv(spark, paths["lookup"], schemas.STOP_LOOKUP))
    at = F.timestamp_seconds(F.lit(args.valid_from)) if args.valid_from is not None else F.current_timestamp()
    sinks.replace(pin(next_versions(before, stations, at), "versions"), output)


def area_as_of_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The area series with each update in the area its station had then."""
    versions = spark.read.schema(VERSIONS).parquet(paths["versions"])
    rows = area_punctuality_as_of(stop_updates(read_feed(spark, paths["feed"])), versions)
    sinks.commit_series(rows, output, schemas.AREA_PUNCTUALITY_KEYED, ["feed_timestamp", "neighbourhood"], _feed_day())


def punctuality_series_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The published city series from the counters of a stream, replacing the one before."""
    series = read_city_snapshots(spark, f"{paths['stream']}/city")
    sinks.replace(sinks.conform(series, schemas.PUNCTUALITY), output)


def area_series_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """Punctuality per feed and area from the counters of a stream, replacing what was there."""
    sinks.replace(read_area_snapshots(spark, f"{paths['stream']}/area"), output)


def feed_profile_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    sinks.replace(feed_profile(read_feed(spark, paths["feed"])), output)


def feed_sample_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    sinks.replace(sample_updates(read_feed(spark, paths["feed"])), output)


def headline_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    counters = city_counters(read_feed(spark, paths["feed"]))
    events = read_multiline_csv(spark, paths["events"], schemas.EVENTS)
    sinks.replace(headline_figures(spark, _clean(spark, paths), counters, events, F.current_date().cast("string")), output)


def area_types_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(area_type_counts(spark.read.parquet(paths["mart"])), output, args)


def ranked_detail_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    _publish(ranked_detail(spark.read.parquet(paths["mart"]), spark.read.parquet(paths["value"])), output, args)


def price_map_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """``geometry`` is the output of area-geometry."""
    sinks.replace(price_map(spark.read.parquet(paths["value"]), spark.read.parquet(paths["geometry"])), output)


def conditions_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    weather = read_weather(spark, paths["weather"], args.place)
    air = read_air_quality(spark, paths["air_quality"], args.place)
    older = F.make_dt_interval(mins=F.lit(args.tolerance_minutes)) if args.tolerance_minutes is not None else None
    merged = merge_conditions(weather, air, tolerance=older)
    day = F.to_date(observation_time(F.col("observed")))
    sinks.commit_series(merged, output, schemas.CONDITIONS_KEYED, ["location", "observed"], day)


def mart_job(spark: SparkSession, paths: Paths, output: str, args) -> None:
    """The mart replaces the one before only after its checks passed."""
    scores = [spark.read.parquet(paths[name]) for name in ("value", "connectivity", "events")]
    mart = stay_score_mart(*scores, weights=tuple(args.weights))
    metrics = {"areas": F.count(F.lit(1)), "best": F.max("stay_score")}
    try:
        counted = sinks.publish(mart, mart_checks, output, args.table, metrics)
    except sinks.ChecksFailed as failed:
        raise SystemExit(f"mart {failed}") from failed
    print(f"mart: {counted['areas']} areas, best score {counted['best']}")


JOBS: dict[str, Callable] = {
    "clean-listings": clean_listings_job,
    "value": value_job,
    "room-types": room_types_job,
    "connectivity": connectivity_job,
    "departures-by-hour": hours_job,
    "raw-events": raw_events_job,
    "events": events_job,
    "events-by-category": categories_job,
    "area-geometry": geometry_job,
    "area-geometry-text": geometry_text_job,
    "area-sizes": area_sizes_job,
    "stop-lookup": stop_lookup_job,
    "punctuality": punctuality_job,
    "area-punctuality": area_punctuality_job,
    "punctuality-stream": punctuality_stream_job,
    "punctuality-state-series": state_series_job,
    "punctuality-windows": windows_job,
    "lookup-versions": lookup_versions_job,
    "area-punctuality-as-of": area_as_of_job,
    "punctuality-series": punctuality_series_job,
    "area-series": area_series_job,
    "feed-profile": feed_profile_job,
    "feed-sample": feed_sample_job,
    "conditions": conditions_job,
    "mart": mart_job,
    "headline-figures": headline_job,
    "area-types": area_types_job,
    "ranked-detail": ranked_detail_job,
    "price-map": price_map_job,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one batch job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input", action="append", default=[], metavar="NAME=PATH")
    parser.add_argument("--output", required=True)
    parser.add_argument("--min-listings", type=int, default=MIN_LISTINGS)
    parser.add_argument("--log-density", action="store_true")
    parser.add_argument("--geojson-lines", action="store_true", help="one GeoJSON document per line")
    parser.add_argument("--partitions", type=int, help="partitions after reading files one task each")
    parser.add_argument("--max-files", type=int, help="landed files of a micro-batch, at most")
    parser.add_argument("--table", help="catalog table to replace as well")
    parser.add_argument("--window", default="1 day", help="length of a tumbling window")
    parser.add_argument("--lateness", default="1 hour", help="how long a window waits for its updates")
    parser.add_argument("--valid-from", type=int, help="epoch seconds from which a lookup holds; now by default")
    parser.add_argument("--place", help="location of landed conditions that name none")
    parser.add_argument("--tolerance-minutes", type=int, help="how much older than the weather an air quality may be")
    parser.add_argument("--weights", type=float, nargs=3, default=(0.5, 0.5, 0.0), metavar=("VALUE", "TRANSIT", "EVENTS"))
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    paths = dict(item.split("=", 1) for item in args.input)
    JOBS[args.job](spark or build_session(f"dwellrank {args.job}"), paths, args.output, args)


if __name__ == "__main__":
    main()
