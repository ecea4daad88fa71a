"""Readers and writers."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from dwellrank import schemas
from dwellrank.session import pin, pin_measured, scratch_root
from dwellrank.sources import sinks
from dwellrank.sources.documents import earliest_events, flatten_events, merge_conditions, read_event_search
from dwellrank.sources.documents import read_air_quality, read_weather
from dwellrank.sources.files import read_csv, read_geojson, read_multiline_csv, read_table, staged_scores
from tests.conftest import rows


def test_csv_is_text_until_cast(spark, tmp_path):
    (tmp_path / "stops.csv").write_text("stop_id,stop_lat,stop_lon\na,52.5,13.4\nb,bad,\n")
    assert rows(read_csv(spark, str(tmp_path / "stops.csv"), schemas.STOPS)) == [("a", "52.5", "13.4"), ("b", "bad", None)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("extra,departure_time,stop_id,trip_id\nx,8:00:00,s,t\n,,s2,\n")
    found = rows(read_csv(spark, str(tmp_path / "t.csv"), schemas.STOP_TIMES))
    assert found == [("t", "s", "8:00:00"), (None, "s2", None)]
    (tmp_path / "n.csv").write_text("n,big,d\n3.0,9007199254740993,2024-05-01\nx,,soon\n")
    found = rows(read_csv(spark, str(tmp_path / "n.csv"), "big bigint, n int, d date"))
    assert found == [(9007199254740993, 3, datetime.date(2024, 5, 1)), (None, None, None)]


def test_gzip_csv_with_line_breaks_and_quotes(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write('k,text\n1,"two\nlines, and ""quotes"""\n2, spaced \n')
    df = read_multiline_csv(spark, str(tmp_path / "x.csv.gz"), "k int, text string", partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert rows(df) == [(1, 'two\nlines, and "quotes"'), (2, " spaced ")]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    texts = ['a"b', "c\nd", " e ", "back\\slash", 'end\\"', "comma,", "ü"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    sinks.replace_csv(df, str(tmp_path / "out"), compression="gzip", rows_per_file=2)
    assert rows(read_multiline_csv(spark, str(tmp_path / "out"), "i int, text string")) == rows(df)


def test_geojson_of_mixed_geometries(spark, tmp_path):
    square = [[0, 0], [1, 0], [1, 1], [0, 0]]

    def feature(name, kind, coordinates):
        return {"type": "Feature", "properties": {"neighbourhood": name}, "geometry": {"type": kind, "coordinates": coordinates}}

    document = {
        "type": "FeatureCollection",
        "features": [
            feature("a", "Polygon", [square, square]),
            feature("b", "MultiPolygon", [[square], [square, square]]),
            feature("c", "Point", [1, 2]),
            {"type": "Feature", "properties": {"neighbourhood": "d"}, "geometry": None},
        ],
    }
    (tmp_path / "areas.geojson").write_text(json.dumps(document, indent=2))
    areas = read_geojson(spark, str(tmp_path / "areas.geojson"))
    shape = F.transform("geometry", lambda p: F.size(p))
    assert rows(areas.select("neighbourhood", "geometry_type", shape.cast("string"))) == [
        ("a", "Polygon", "[2]"),
        ("b", "MultiPolygon", "[1, 2]"),
        ("c", "Point", None),
        ("d", None, None),
    ]


def test_event_search_with_missing_and_empty_lists(spark, tmp_path):
    full = {
        "name": "n1",
        "dates": {"start": {"localDate": "2024-05-01"}},
        "_embedded": {"venues": [{"name": "v", "location": {"latitude": "52.5", "longitude": "13.4"}}, {"name": "w"}]},
        "classifications": [{"segment": {"name": "Music"}}, {"segment": {"name": "Other"}}],
    }
    events = [
        full,
        {"name": "n2", "dates": {"start": {"localDate": "soon"}}, "_embedded": {"venues": []}, "classifications": []},
        {"name": "n3", "_embedded": {"venues": [{"name": "v3"}]}},
        {"name": "n4"},
    ]
    (tmp_path / "page.json").write_text(json.dumps({"_embedded": {"events": events}}))
    (tmp_path / "none.json").write_text(json.dumps({"page": {"size": 0}}))
    flat = flatten_events(read_event_search(spark, str(tmp_path)))
    assert rows(flat) == [
        ("n1", datetime.date(2024, 5, 1), "v", 52.5, 13.4, "Music"),
        ("n2", None, None, None, None, None),
        ("n3", None, "v3", None, None, None),
        ("n4", None, None, None, None, None),
    ]
    assert [r.name for r in earliest_events(flat, 2).collect()] == ["n1", "n2"]


def test_conditions(spark, tmp_path):
    weather = {"location": "x", "current": {"time": "t", "temperature_2m": 7.5, "rain": 0.0, "weather_code": 3}}
    air = {"location": "x", "current": {"time": "t", "european_aqi": 20, "pm10": 5.5}}
    (tmp_path / "w.json").write_text(json.dumps(weather))
    (tmp_path / "a.json").write_text(json.dumps(air))
    merged = merge_conditions(read_weather(spark, str(tmp_path / "w.json")), read_air_quality(spark, str(tmp_path / "a.json")))
    out = str(tmp_path / "series")
    sinks.append(merged, out, schemas.CONDITIONS)
    sinks.append(merged, out, schemas.CONDITIONS)
    stored = spark.read.schema(schemas.CONDITIONS).parquet(out)
    assert stored.count() == 2
    first = stored.first()
    assert (first.temperature_c, first.humidity_pct, first.weather_code, first.european_aqi, first.pm10) == (7.5, None, 3, 20.0, 5.5)
    assert first.snapshot_time is not None


def test_replace_counts_in_the_same_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "k int, v double")
    metrics = {"n": F.count(F.lit(1)), "known": F.count("v")}
    assert sinks.replace_with_metrics(df, str(tmp_path / "t"), metrics) == {"n": 2, "known": 1}
    assert sinks.replace_with_metrics(df.limit(1), str(tmp_path / "t"), metrics)["n"] == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_catalog_tables_are_replaced_and_dropped(spark, tmp_path):
    sinks.replace_table(spark.range(5), "replaced_numbers", str(tmp_path / "t"))
    sinks.replace_table(spark.range(3), "replaced_numbers", str(tmp_path / "t"))
    assert read_table(spark, "replaced_numbers").count() == 3
    sinks.drop_table(spark, "replaced_numbers")
    sinks.drop_table(spark, "replaced_numbers")
    assert not spark.catalog.tableExists("replaced_numbers")


def test_staged_scores(spark):
    df = spark.createDataFrame([("a", "1.5"), ("b", "bad")], "neighbourhood string, score string")
    df.createOrReplaceTempView("score_source")
    assert rows(staged_scores(spark, "score_source", "score")) == [("a", 1.5), ("b", None)]


def test_pin_reads_back_the_same_rows(spark):
    df = spark.range(100).select(F.col("id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    pinned, counted = pin_measured(df, n=F.count(F.lit(1)), lowest=F.min("id"))
    assert counted == {"n": 100, "lowest": 0} and rows(pinned) == rows(df)
    assert pin(df.limit(0)).count() == 0


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")
    else:
        assert scratch_root(spark)


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert sinks.conform(df, "a string, b bigint").dtypes == [("a", "string"), ("b", "bigint")]


def test_missing_declared_column_fails(spark):
    with pytest.raises(Exception):
        sinks.conform(spark.range(1), "missing string").count()
