"""The command-line jobs end to end on small files."""

import gzip
import json

import pytest

from dwellrank import jobs, schemas
from dwellrank.sources.files import read_csv, read_multiline_csv
from dwellrank.sources.sinks import drop_table, read_series, replace_csv
from tests.conftest import rows

HEADER = (
    "id,latitude,longitude,neighbourhood_cleansed,neighbourhood_group_cleansed,room_type,property_type,accommodates,"
    "bedrooms,price,review_scores_rating,review_scores_location,number_of_reviews,estimated_occupancy_l365d,"
    "estimated_revenue_l365d"
)


@pytest.fixture(scope="module")
def city(tmp_path_factory):
    """Three unit squares A, B, C in a row; C without transit."""
    root = tmp_path_factory.mktemp("city")

    def square(i):
        return [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]]

    features = [
        {
            "type": "Feature",
            "properties": {"neighbourhood": name},
            "geometry": {"type": "Polygon", "coordinates": square(i)},
        }
        for i, name in enumerate("ABC")
    ]
    (root / "areas.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    listings = ["description," + HEADER]
    for name, base in (("A", 50), ("B", 100), ("C", 300)):
        listings += [f'"near the\nlake, quiet",1,0,0,{name},G,Entire home,x,2,1,"${base}.00",5,5,1,1,1'] * 30
    with gzip.open(root / "listings.csv.gz", "wt") as f:
        f.write("\n".join(listings) + "\n")
    stops = ["stop_id,stop_lat,stop_lon", "de:11000:1:1,0.5,0.5", "de:11000:2:1,0.5,1.5", "de:11000:3:1,9,9"]
    (root / "stops.csv").write_text("\n".join(stops) + "\n")
    times = ["trip_id,stop_id,departure_time"] + ["t,de:11000:1:1,8:00:00"] * 9 + ["t,de:11000:2:1,24:30:00"] * 4
    (root / "stop_times.csv").write_text("\n".join(times) + "\n")
    events = [
        {
            "name": f"e{i}",
            "dates": {"start": {"localDate": "2024-05-01"}},
            "_embedded": {"venues": [{"name": "v", "location": {"latitude": "0.5", "longitude": str(x)}}]},
        }
        for i, x in enumerate([0.5, 0.5, 1.5])
    ]
    (root / "search.json").write_text(json.dumps({"_embedded": {"events": events}}))
    update = {"stop_id": "de:11000:1:7", "arrival": {"delay": 30}}
    entity = {"trip_update": {"trip": {"trip_id": "t"}, "stop_time_update": [update]}}
    feed = root / "feed"
    feed.mkdir()
    (feed / "1.json").write_text(json.dumps({"header": {"timestamp": 7}, "entity": [entity]}))
    (root / "weather.json").write_text(json.dumps({"location": "x", "current": {"time": "t", "rain": 1.0}}))
    (root / "air.json").write_text(json.dumps({"location": "x", "current": {"time": "t", "ozone": 2.0}}))
    return root


def run(spark, job, output, *options, **inputs):
    argv = [job, "--output", str(output), *options]
    for name, path in inputs.items():
        argv += ["--input", f"{name}={path}"]
    jobs.main(argv, spark)
    return str(output)


def test_from_files_to_the_mart(spark, city):
    geojson = city / "areas.geojson"
    clean = run(spark, "clean-listings", city / "clean", listings=city / "listings.csv.gz")
    value = run(spark, "value", city / "value", listings=clean)
    assert rows(spark.read.parquet(value)) == [("A", 30, 50.0, 100.0), ("B", 30, 100.0, 80.0), ("C", 30, 300.0, 0.0)]
    assert spark.read.parquet(run(spark, "value", city / "none", "--min-listings", "31", listings=clean)).count() == 0
    rooms = run(spark, "room-types", city / "rooms", listings=clean)
    assert rows(spark.read.parquet(rooms)) == [("Entire home", 90, 150.0, 100.0)]

    lookup = run(spark, "stop-lookup", city / "lookup", stops=city / "stops.csv", geojson=geojson)
    sizes = run(spark, "area-sizes", city / "sizes", geojson=geojson)
    transit = {"stop_times": city / "stop_times.csv", "lookup": lookup}
    connectivity = run(spark, "connectivity", city / "connectivity", **transit, areas=sizes)
    found = rows(spark.read.parquet(connectivity).drop("area_km2"))
    assert found == [("A", 9, 1, 100.0), ("B", 4, 1, 0.0)]
    logged = run(spark, "connectivity", city / "connectivity-log", "--log-density", **transit, areas=sizes)
    assert rows(spark.read.parquet(logged).drop("area_km2")) == found
    hours = run(spark, "departures-by-hour", city / "hours", **transit)
    assert rows(spark.read.parquet(hours)) == [("A", 8, 9), ("B", 0, 4)]

    raw = run(spark, "raw-events", city / "raw-events", search=city / "search.json")
    events = run(spark, "events", city / "events", events=raw, geojson=geojson)
    assert rows(spark.read.parquet(events)) == [("A", 2, 100.0), ("B", 1, 0.0)]
    categories = run(spark, "events-by-category", city / "categories", events=raw, geojson=geojson)
    assert rows(spark.read.parquet(categories)) == [("A", "Other", 2, 2), ("B", "Other", 1, 1)]
    geometry = run(spark, "area-geometry", city / "geometry", geojson=geojson)
    assert spark.read.parquet(geometry).filter("geometry is not null").count() == 3

    scores = {"value": value, "connectivity": connectivity, "events": events}
    mart = run(spark, "mart", city / "mart", "--table", "stay_score_of_jobs", **scores)
    assert spark.table("stay_score_of_jobs").count() == 2
    drop_table(spark, "stay_score_of_jobs")
    assert not spark.catalog.tableExists("stay_score_of_jobs")
    found = spark.read.parquet(mart).select("neighbourhood", "stay_score", "overall_rank", "events_score")
    assert rows(found) == [("A", 100.0, 1, 100.0), ("B", 40.0, 2, 0.0)]
    types = run(spark, "area-types", city / "types", mart=mart)
    assert spark.read.parquet(types).agg({"areas": "sum"}).first()[0] == 2
    detail = run(spark, "ranked-detail", city / "detail", mart=mart, value=value)
    assert rows(spark.read.parquet(detail).select("neighbourhood", "overall_rank", "median_price")) == [("A", 1, 50.0), ("B", 2, 100.0)]
    prices = run(spark, "price-map", city / "prices", value=value, geometry=geometry)
    assert spark.read.parquet(prices).filter("geometry_wkt like '%POLYGON%'").count() == 3
    figures = run(spark, "headline-figures", city / "figures", listings=clean, events=raw, feed=city / "feed")
    assert tuple(spark.read.parquet(figures).first())[:3] == (90, 150.0, 100.0)


def test_series_jobs_add_each_feed_once(spark, city):
    """Run again, as after a failure, a series job adds nothing; a new feed adds its rows."""
    lookup = city / "stations.csv"
    lookup.write_text("stop_id,neighbourhood\nde:11000:1:1,A\n")
    for _ in range(2):
        series = run(spark, "punctuality", city / "punctuality", feed=city / "feed")
        conditions = run(spark, "conditions", city / "conditions", weather=city / "weather.json", air_quality=city / "air.json")
        areas = run(spark, "area-punctuality", city / "area-punctuality", feed=city / "feed", lookup=lookup)
    assert [r.pct_on_time for r in spark.read.parquet(series).collect()] == [100.0]
    assert [(r.rain_mm, r.ozone) for r in spark.read.parquet(conditions).collect()] == [(1.0, 2.0)]
    stored = read_series(spark, areas, schemas.AREA_PUNCTUALITY)
    assert [tuple(r)[:4] for r in stored.collect()] == [("A", 1, 100.0, 30.0)]
    later = city / "later-feed"
    later.mkdir()
    text = (city / "feed" / "1.json").read_text()
    (later / "1.json").write_text(text)
    (later / "2.json").write_text(text.replace('"timestamp": 7', '"timestamp": 8').replace('"delay": 30', '"delay": 90'))
    run(spark, "punctuality", city / "punctuality", feed=later)
    found = read_series(spark, series, schemas.PUNCTUALITY).select("feed_timestamp", "pct_on_time")
    assert rows(found) == [(7, 100.0), (8, 0.0)]


def test_conditions_of_services_that_name_no_place(spark, city):
    (city / "plain-weather.json").write_text(json.dumps({"current": {"time": "2024-05-01T10:15", "rain": 1.5}}))
    (city / "plain-air.json").write_text(json.dumps({"current": {"time": "2024-05-01T10:00", "ozone": 40.0}}))
    landed = {"weather": city / "plain-weather.json", "air_quality": city / "plain-air.json"}
    out = run(spark, "conditions", city / "as-of", "--place", "here", "--tolerance-minutes", "60", **landed)
    found = read_series(spark, out, schemas.CONDITIONS_KEYED).select("location", "observed", "rain_mm", "ozone")
    assert rows(found) == [("here", "2024-05-01T10:15", 1.5, 40.0)]
    strict = run(spark, "conditions", city / "as-of-strict", "--tolerance-minutes", "5", **landed)
    assert rows(read_series(spark, strict, schemas.CONDITIONS).select("rain_mm", "ozone")) == [(1.5, None)]


def test_stream_job_reads_each_file_once(spark, city):
    lookup = city / "stream-stations.csv"
    lookup.write_text("stop_id,neighbourhood\nde:11000:1:1,A\n")
    for _ in range(2):
        out = run(spark, "punctuality-stream", city / "stream", feed=city / "feed", lookup=lookup)
    assert spark.read.parquet(f"{out}/city").count() == 1
    assert spark.read.parquet(f"{out}/area").count() == 1
    series = run(spark, "punctuality-series", city / "series", stream=out)
    assert [r.pct_on_time for r in spark.read.parquet(series).collect()] == [100.0]
    areas = run(spark, "area-series", city / "area-series", stream=out)
    assert [r.neighbourhood for r in spark.read.parquet(areas).collect()] == ["A"]
    assert spark.read.parquet(run(spark, "feed-profile", city / "profile", feed=city / "feed")).first().entities == 1
    assert spark.read.parquet(run(spark, "feed-sample", city / "sample", feed=city / "feed")).count() == 1


def test_event_names_with_line_breaks_survive_the_hand_over(spark, city):
    events = [("Fair\nby the river", "2030-01-01", 1.0)]
    out = str(city / "broken-lines")
    replace_csv(spark.createDataFrame(events, "name string, date string, price double"), out)
    assert rows(read_multiline_csv(spark, out, "name string, date string, price double")) == events


def test_reordered_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), "x int, y int").collect()


def test_mart_job_fails_on_broken_contract(spark, tmp_path):
    spark.createDataFrame([("A", None)], "neighbourhood string, value_score double").write.parquet(str(tmp_path / "v"))
    spark.createDataFrame([("A", 1.0)], "neighbourhood string, connectivity_score double").write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([("A", 1.0)], "neighbourhood string, events_score double").write.parquet(str(tmp_path / "e"))
    scores = {"connectivity": tmp_path / "c", "events": tmp_path / "e"}
    spark.createDataFrame([("A", 2.0)], "neighbourhood string, value_score double").write.parquet(str(tmp_path / "good"))
    options = [tmp_path / "mart", "--table", "mart_that_stays"]
    run(spark, "mart", *options, value=tmp_path / "good", **scores)
    before = rows(spark.read.parquet(str(tmp_path / "mart")))
    with pytest.raises(SystemExit, match="stay_score"):
        run(spark, "mart", *options, value=tmp_path / "v", **scores)
    # What was published stays, and nothing is left of the staging.
    assert rows(spark.read.parquet(str(tmp_path / "mart"))) == before == rows(spark.table("mart_that_stays"))
    assert [t.name for t in spark.catalog.listTables() if "staging" in t.name or "__" in t.name] == []
    drop_table(spark, "mart_that_stays")


def test_score_tables_out_of_range_are_not_published(spark, city):
    from dwellrank.plans.mart import value_checks

    wrong = spark.createDataFrame([("A", 101.0), ("A", None), (None, 5.0)], "neighbourhood string, value_score double")
    found = {(r.check, r.column): r.failures for r in value_checks(wrong).collect()}
    assert found == {("unique", "neighbourhood"): 1, ("in_range", "value_score"): 1}
