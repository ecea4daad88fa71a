"""Feed parsing, punctuality and streams."""

import json

import pytest
from pyspark.sql import functions as F

from dwellrank import schemas
from dwellrank.operators.joins import station_areas
from dwellrank.plans.punctuality import area_punctuality, city_counters, city_snapshots, feed_profile
from dwellrank.sources.feed import read_feed, sample_updates, stop_updates
from dwellrank.streaming.punctuality import (
    append_stream,
    read_area_snapshots,
    read_city_snapshots,
    run_counters,
    windowed_punctuality,
)
from tests.conftest import rows


def update(stop=None, delay=None, arrival=True):
    item = {}
    if stop is not None:
        item["stop_id"] = stop
    if arrival:
        item["arrival"] = {} if delay is None else {"delay": delay}
    return item


def trip(name, *updates):
    return {"trip_update": {"trip": {"trip_id": name, "route_id": "r"}, "stop_time_update": list(updates)}}


VEHICLE = {"vehicle": {"trip": {"trip_id": "v"}}}


def message(stamp, *entities):
    return {"header": {"timestamp": stamp}, "entity": list(entities)}


ONE = message(
    100,
    trip("t1", update("de:1:1:a", -7200), update("de:1:1:a", -7199), update("de:1:1:a", -61), update("de:1:1:b", -60)),
    trip("t2", update("de:1:2", 60), update("de:1:2", 61), update("de:1:2", 7200), update(None, 30)),
    trip("t3", update("de:1:9", 5), update("zz", 5), update("de:1:2"), update("de:1:2", arrival=False)),
    trip("t4"),
    VEHICLE,
)
EMPTY = message(200)
TWO = message(300, trip("t1", update("de:1:1:a", 10)))

CITY_ONE = (100, 5, 8, 5, 1, 2, 62.5, -894.9)
CITY = [CITY_ONE, (200, 0, 0, 0, 0, 0, 0.0, 0.0), (300, 1, 1, 1, 0, 0, 100.0, 10.0)]


def land(path, *messages):
    path.mkdir(exist_ok=True)
    for i, m in enumerate(messages):
        name = f"{m['header']['timestamp']}-{i}-{len(list(path.iterdir()))}.json"
        (path / name).write_text(json.dumps(m))
    return str(path)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("de:1:1:a", "A"), ("de:1:2", "B"), ("de:1:3", "C")], schemas.STOP_LOOKUP)


def city_rows(df):
    return sorted(tuple(r)[1:] for r in df.collect())


def test_city_snapshot(spark, tmp_path):
    feed = read_feed(spark, land(tmp_path / "feed", ONE, EMPTY, TWO))
    # The delays of the first feed that count: -7199 -61 -60 60 61 30 5 5.
    assert city_rows(city_snapshots(city_counters(feed))) == CITY


def test_city_snapshot_of_a_feed_in_pieces(spark, tmp_path):
    pieces = [message(100, entity) for entity in ONE["entity"]]
    feed = read_feed(spark, land(tmp_path / "feed", *pieces))
    assert city_rows(city_snapshots(city_counters(feed))) == [CITY_ONE]


def test_stop_updates_need_stop_and_delay(spark, tmp_path):
    feed = read_feed(spark, land(tmp_path / "feed", ONE))
    assert stop_updates(feed).count() == 9


def test_area_punctuality(spark, tmp_path, lookup):
    updates = stop_updates(read_feed(spark, land(tmp_path / "feed", ONE, EMPTY, TWO)))
    found = rows(area_punctuality(updates, lookup).drop("snapshot_time"))
    assert found == [(100, "A", 3, 33.3, -2440.0), (100, "B", 2, 50.0, 60.5), (300, "A", 1, 100.0, 10.0)]


def test_empty_feed_gives_no_area_rows(spark, tmp_path, lookup):
    updates = stop_updates(read_feed(spark, land(tmp_path / "feed", EMPTY)))
    assert area_punctuality(updates, lookup).count() == 0


def test_feed_profile(spark, tmp_path):
    feed = read_feed(spark, land(tmp_path / "feed", ONE))
    assert rows(feed_profile(feed)) == [(100, 5, 4, 1, 10, 5, 2, 3, 120, -120)]


def test_sample_has_placeholders(spark, tmp_path):
    sample = rows(sample_updates(read_feed(spark, land(tmp_path / "feed", ONE))))
    assert ("t2", 4, "(no stop_id)", "30") in sample
    assert ("t3", 4, "de:1:2", "(no delay)") in sample
    assert len(sample) == 12


def test_stream_equals_batch_over_several_runs(spark, tmp_path, lookup):
    feed = tmp_path / "feed"
    city, area, state = (str(tmp_path / n) for n in ("city", "area", "state"))
    stations = station_areas(lookup)
    pieces = [message(100, entity) for entity in ONE["entity"]]
    land(feed, *pieces[:2])
    run_counters(spark, str(feed), state, city, area, stations, max_files=1)
    land(feed, *pieces[2:], EMPTY, TWO)
    run_counters(spark, str(feed), state, city, area, stations, max_files=2)
    run_counters(spark, str(feed), state, city, area, stations)  # nothing new
    assert city_rows(read_city_snapshots(spark, city)) == CITY
    assert rows(read_area_snapshots(spark, area).drop("snapshot_time")) == [
        (100, "A", 3, 33.3, -2440.0),
        (100, "B", 2, 50.0, 60.5),
        (300, "A", 1, 100.0, 10.0),
    ]


def test_replayed_stream_replaces_its_rows(spark, tmp_path):
    feed, city = land(tmp_path / "feed", ONE, TWO), str(tmp_path / "city")
    run_counters(spark, feed, str(tmp_path / "state-1"), city)
    run_counters(spark, feed, str(tmp_path / "state-2"), city)  # same batches again after losing the state
    assert city_rows(read_city_snapshots(spark, city)) == [CITY[0], CITY[2]]


def test_lost_state_and_other_batches_count_files_once(spark, tmp_path, lookup):
    feed, city, area = tmp_path / "feed", str(tmp_path / "city"), str(tmp_path / "area")
    stations = station_areas(lookup)
    land(feed, *[message(100, entity) for entity in ONE["entity"]], EMPTY, TWO)
    run_counters(spark, str(feed), str(tmp_path / "state-1"), city, area, stations, max_files=2)
    before = city_rows(read_city_snapshots(spark, city)), rows(read_area_snapshots(spark, area).drop("snapshot_time"))
    run_counters(spark, str(feed), str(tmp_path / "state-2"), city, area, stations, max_files=3)
    after = city_rows(read_city_snapshots(spark, city)), rows(read_area_snapshots(spark, area).drop("snapshot_time"))
    assert before == after and before[0] == CITY


def test_windows_close_and_late_rows_drop(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "at timestamp, delay int"

    def arrive(*items):
        data = spark.createDataFrame(list(items), "at string, delay int").select(F.col("at").cast("timestamp").alias("at"), "delay")
        data.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append_stream(windowed_punctuality(stream, "at"), out, state)

    arrive(("2024-01-01 10:00:00", 10), ("2024-01-01 11:00:00", 100), ("2024-01-01 12:00:00", 9999))
    arrive(("2024-01-02 00:30:00", 0))
    arrive(("2024-01-01 23:50:00", 40), ("2024-01-02 05:00:00", 0))
    arrive(("2024-01-01 23:59:00", 5), ("2024-01-03 05:00:00", 0))  # the first is later than the watermark
    found = spark.read.parquet(out).orderBy("window_start").drop("window_start")
    assert [tuple(r) for r in found.collect()] == [(3, 66.7, 50.0), (2, 100.0, 0.0)]
