"""Keyed series, streams with state, late updates and lookups that change."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from dwellrank import jobs, schemas
from dwellrank.plans.versions import area_punctuality_as_of, next_versions
from dwellrank.sources import sinks
from dwellrank.streaming.series import run_series
from dwellrank.streaming.windows import read_late, read_windows, run_windows
from tests.conftest import rows

DAY = 86400
SCHEMA = "k bigint, v string"


def message(stamp, *delays, stop="de:1:1:a"):
    updates = [{"stop_id": stop, "arrival": {"delay": d}} for d in delays]
    return {"header": {"timestamp": stamp}, "entity": [{"trip_update": {"trip": {"trip_id": "t"}, "stop_time_update": updates}}]}


def land(path, *messages):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(m) for m in messages))
    return str(path)


def part():
    return F.floor(F.col("k") / 10)


def test_commit_adds_each_key_once(spark, tmp_path):
    path = str(tmp_path / "s")
    frame = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    assert sinks.commit_series(frame((1, "a"), (1, "b"), (12, "c"), (None, "n")), path, SCHEMA, ["k"], part()) == 3
    assert sinks.commit_series(frame((1, "z"), (12, "z"), (None, "z")), path, SCHEMA, ["k"], part()) == 0
    assert sinks.commit_series(frame((2, "d"), (25, "e"), (1, "z")), path, SCHEMA, ["k"], part()) == 2
    assert rows(sinks.read_series(spark, path, SCHEMA)) == [(1, "a"), (12, "c"), (2, "d"), (25, "e"), (None, "n")]
    assert sinks.commit_series(frame((1, "x")).limit(0), str(tmp_path / "empty"), SCHEMA, ["k"], part()) == 0
    assert sinks.read_series(spark, str(tmp_path / "empty"), SCHEMA).count() == 0


def test_merge_replaces_the_rows_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "s")
    for r in ([(1, "a"), (2, "b"), (11, "c")], [(2, "new"), (3, "d")], [(2, "new"), (3, "d")]):
        sinks.merge_series(spark.createDataFrame(r, SCHEMA), path, SCHEMA, ["k"], part())
    assert rows(sinks.read_series(spark, path, SCHEMA)) == [(1, "a"), (11, "c"), (2, "new"), (3, "d")]


def test_publish_leaves_what_is_there_when_checks_fail(spark, tmp_path):
    path, good = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], SCHEMA)
    check = lambda df: df.agg(F.count_if(F.col("v").isNull()).alias("failures"))
    counted = sinks.publish(good, check, path, "published_t", {"n": F.count(F.lit(1))})
    assert counted == {"n": 1}
    with pytest.raises(sinks.ChecksFailed, match="1"):
        sinks.publish(spark.createDataFrame([(2, None)], SCHEMA), check, path, "published_t")
    assert rows(spark.read.parquet(path)) == rows(spark.table("published_t")) == [(1, "a")]
    sinks.publish(spark.createDataFrame([(3, "c")], SCHEMA), check, path, "published_t")
    assert rows(spark.read.parquet(path)) == rows(spark.table("published_t")) == [(3, "c")]
    sinks.drop_table(spark, "published_t")
    assert [t.name for t in spark.catalog.listTables()] == []


def test_state_takes_up_a_feed_in_many_parts(spark, tmp_path):
    feed, series = tmp_path / "feed", str(tmp_path / "series")

    def run(lateness="3 days"):
        run_series(spark, str(feed), str(tmp_path / "state"), series, lateness=lateness)
        found = sinks.read_series(spark, series, schemas.PUNCTUALITY)
        return sorted(rows(found.select("feed_timestamp", "active_trips", "total_stop_updates", "on_time")))

    land(feed, message(10 * DAY, 10, 90), message(10 * DAY, 5))
    assert run() == [(10 * DAY, 2, 3, 2)]
    land(feed, message(10 * DAY, 500))
    land(feed, message(12 * DAY, 0))
    assert run() == [(10 * DAY, 3, 4, 2), (12 * DAY, 1, 1, 1)]
    assert run() == [(10 * DAY, 3, 4, 2), (12 * DAY, 1, 1, 1)]  # nothing new
    land(feed, message(30 * DAY, 0))
    run()
    land(feed, message(12 * DAY, 7))  # long behind: the row that was published stays
    assert run() == [(10 * DAY, 3, 4, 2), (12 * DAY, 1, 1, 1), (30 * DAY, 1, 1, 1)]


def test_late_updates_are_kept_aside(spark, tmp_path):
    feed, out = tmp_path / "feed", str(tmp_path / "out")

    def run():
        run_windows(spark, str(feed), str(tmp_path / "state"), out)
        return sorted(rows(read_windows(spark, out).select(F.unix_seconds("window_start"), "updates", "closed")))

    land(feed, message(DAY, 0, 9000), message(DAY + 100, 70))
    assert run() == [(DAY, 2, False)]
    land(feed, message(2 * DAY + 3600, 0))  # the watermark reaches the end of the first day
    assert run() == [(DAY, 2, True), (2 * DAY, 1, False)]
    land(feed, message(DAY + 50, 1, 2), message(2 * DAY + 50, 3))
    assert run() == [(DAY, 2, True), (2 * DAY, 2, False)]
    assert [(r.stop_id, r.delay, r.batch_id) for r in read_late(spark, out).orderBy("delay").collect()] == [("de:1:1:a", 1, 2), ("de:1:1:a", 2, 2)]
    assert run() == [(DAY, 2, True), (2 * DAY, 2, False)]  # nothing new


def test_window_job(spark, tmp_path, capsys):
    feed = land(tmp_path / "feed", message(DAY, 0, 70))
    jobs.main(["punctuality-windows", "--input", f"feed={feed}", "--output", str(tmp_path / "w"), "--window", "12 hours"], spark)
    assert [(r.updates, r.pct_on_time) for r in spark.read.parquet(str(tmp_path / "w" / "windows")).collect()] == [(2, 50.0)]
    assert "late updates: 0" in capsys.readouterr().out
    jobs.main(["punctuality-state-series", "--input", f"feed={feed}", "--output", str(tmp_path / "s")], spark)
    assert sinks.read_series(spark, str(tmp_path / "s" / "series"), schemas.PUNCTUALITY).first().total_stop_updates == 2


def at(seconds):
    return datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc).replace(tzinfo=None)


@pytest.fixture
def versions(spark):
    """Station 1 moves from A to B, station 2 stays, 3 ends, 4 is new."""
    lookup = lambda *r: spark.createDataFrame(list(r), "station string, neighbourhood string")
    first = next_versions(None, lookup(("de:1:1", "A"), ("de:1:2", "A"), ("de:1:3", "C")), F.timestamp_seconds(F.lit(0)))
    second = lookup(("de:1:1", "B"), ("de:1:2", "A"), ("de:1:4", "D"))
    return next_versions(first, second, F.timestamp_seconds(F.lit(100))), second


def test_versions_follow_the_lookup(spark, versions):
    table, lookup = versions
    seconds = ["station", "neighbourhood", F.unix_seconds("valid_from"), F.unix_seconds("valid_to")]
    expected = [("de:1:1", "A", 0, 100), ("de:1:1", "B", 100, None), ("de:1:2", "A", 0, None), ("de:1:3", "C", 0, 100), ("de:1:4", "D", 100, None)]
    assert rows(table.select(*seconds)) == expected
    assert rows(next_versions(table, lookup, F.timestamp_seconds(F.lit(200))).select(*seconds)) == expected


@pytest.mark.parametrize("limit", [1000, 0])
def test_updates_count_where_their_station_was(spark, versions, limit):
    table, _ = versions
    updates = [(f"de:1:{s}:x", t, 10) for s in (1, 2, 3, 4, 9) for t in (50, 99, 100, 150)] + [("de:1:1:x", 150, 90), (None, 50, 1)]
    frame = spark.createDataFrame(updates, "stop_id string, feed_timestamp bigint, delay int")
    found = area_punctuality_as_of(frame, table, keys=(), max_broadcast_rows=limit).select("neighbourhood", "updates", "pct_on_time")
    assert rows(found) == [("A", 6, 100.0), ("B", 3, 66.7), ("C", 2, 100.0), ("D", 2, 100.0)]


def test_version_jobs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("stop_id,neighbourhood\nde:1:1:a,A\n")
    (tmp_path / "b.csv").write_text("stop_id,neighbourhood\nde:1:1:a,B\n")
    run = lambda job, out, *o, **i: jobs.main([job, "--output", str(tmp_path / out), *o, *[x for k, v in i.items() for x in ("--input", f"{k}={v}")]], spark)
    run("lookup-versions", "v1", "--valid-from", "0", lookup=tmp_path / "a.csv")
    run("lookup-versions", "v2", "--valid-from", "100", lookup=tmp_path / "b.csv", versions=tmp_path / "v1")
    feed = land(tmp_path / "feed", message(50, 0), message(150, 0))
    run("area-punctuality-as-of", "series", feed=feed, versions=tmp_path / "v2")
    found = sinks.read_series(spark, str(tmp_path / "series"), schemas.AREA_PUNCTUALITY_KEYED)
    assert rows(found.select("feed_timestamp", "neighbourhood", "updates")) == [(150, "B", 1), (50, "A", 1)]
