"""Literal-row cases of the scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from dwellrank.functions import scalars as fn


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, hour", [("25:10:00", 1), ("08:00:00", 8), ("24:00:00", 0), ("", None), (None, None), ("abc", None), ("7:5", 7)]
)
def test_service_hour(spark, text, hour):
    assert values(spark, "string", [text], fn.service_hour) == [hour]


def test_has_text(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "v string")
    assert [r.v for r in df.filter(fn.has_text(F.col("v"))).collect()] == ["a"]


def test_money(spark):
    texts = ["$1,234.00", "$10.00", "$9.99", "12", "free", "", None]
    assert values(spark, "string", texts, fn.money) == [1234.0, 10.0, 9.99, 12.0, None, None, None]


def test_plausible_price_keeps_both_limits(spark):
    prices = [9.99, 10.0, 1000.0, 1000.01, None]
    assert values(spark, "double", prices, fn.plausible_price) == [None, 10.0, 1000.0, None, None]


def test_delay_limits(spark):
    delays = [-7200, -7199, -61, -60, 60, 61, 7199, 7200]
    assert values(spark, "int", delays, fn.usable_delay) == [False, True, True, True, True, True, True, False]
    assert values(spark, "int", delays, fn.is_on_time) == [False, False, False, True, True, False, False, False]
    assert values(spark, "int", delays, fn.is_early) == [True, True, True, False, False, False, False, False]
    assert values(spark, "int", delays, fn.is_late) == [False, False, False, False, False, True, True, True]


def test_floor_minutes(spark):
    assert values(spark, "int", [-90, -60, 0, 59, 61], fn.floor_minutes) == [-2, -1, 0, 0, 1]


def test_station_forms(spark):
    ids = ["de:11000:900160004:2:53", "xde:1:2", "zz", None]
    assert values(spark, "string", ids, fn.station_or_blank) == ["de:11000:900160004", "de:1:2", "", None]
    assert values(spark, "string", ids, fn.station_or_null) == ["de:11000:900160004", None, None, None]


def test_lenient_casts(spark):
    assert values(spark, "string", ["1.5", "x", None], fn.to_double) == [1.5, None, None]
    assert values(spark, "string", ["7", "7x", None], fn.to_int) == [7, None, None]


def test_epoch_ignores_the_session_time_zone(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, 0, 7),)], "v timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(fn.epoch_seconds(F.col("v"))).first()[0] == 1704067207
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_exact_mean_does_not_depend_on_order(spark):
    numbers = [0.1, 0.2, 0.3, 1e6, -1e6, 0.7]
    means = set()
    for order in (numbers, numbers[::-1], sorted(numbers)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        means.add(df.agg(fn.exact_mean(F.col("v"))).first()[0])
    assert means == {1.3 / 6}
