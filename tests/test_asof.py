"""As-of joins against brute force, in one and in many range partitions."""

import random

import pytest
from pyspark.sql import functions as F

from dwellrank.operators.asof import asof_join
from dwellrank.sources.documents import merge_conditions, observation_time
from tests.conftest import rows

LEFT, RIGHT = "id int, k string, t int, note string", "k string, t int, v int, w string"


def brute(left, right, tolerance=None):
    out = []
    for i, k, t, note in left:
        fit = [r for r in right if k is not None and t is not None and r[1] is not None and r[0] == k and r[1] <= t]
        best = max(fit, key=lambda r: (r[1], (r[2] is not None, r[2] or 0), (r[3] is not None, r[3] or "")), default=None)
        if best and tolerance is not None and t - best[1] > tolerance:
            best = None
        out.append((i, k, t, note, *(best[1:] if best else (None,) * 3)))
    return sorted(out, key=repr)


@pytest.fixture(params=["one slice", "many slices"])
def slices(request, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param == "one slice").lower())
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def streams():
    """A key with most of the rows, one moment with a third of them, nulls and ties."""
    rng = random.Random(7)
    left = [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *range(60)]), "n") for i in range(300)]
    left += [(1000, "hot", 33, "same")] * 150 + [(1001, "z", 5, "no partner")]
    right = [(rng.choice(["hot"] * 6 + ["a", "b", "c", None]), rng.choice([None, *range(0, 60, 3)]), rng.choice([None, 1, 2, 3]), "w") for _ in range(120)]
    return left, right


@pytest.mark.parametrize("tolerance", [None, 0, 4])
def test_equals_brute_force(spark, slices, streams, tolerance):
    left, right = streams
    found = asof_join(
        spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3), ["k"], "t",
        None if tolerance is None else F.lit(tolerance),
    )
    assert found.columns == ["id", "k", "t", "note", "t_matched", "v", "w"]
    assert rows(found) == brute(left, right, tolerance)


def test_keys_that_skip_partitions(spark, slices):
    """The last earlier row of a key may lie many partitions back."""
    left = [(i, "k", i, "x") for i in range(1, 400)]
    right = [("k", 0, 7, "first"), ("other", 200, 1, "y")]
    found = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t")
    assert rows(found) == brute(left, right)


def test_inner_prefix_and_clashes(spark):
    left = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", 5, "y")], LEFT)
    right = spark.createDataFrame([("a", 4, "r")], "k string, t int, note string")
    found = asof_join(left, right, ["k"], "t", prefix="last_", how="inner")
    assert [r.asDict() for r in found.collect()] == [{"id": 1, "k": "a", "t": 5, "note": "x", "last_t_matched": 4, "last_note": "r"}]
    with pytest.raises(ValueError, match="note"):
        asof_join(left, right, ["k"], "t")


def test_empty_sides(spark):
    left, right = spark.createDataFrame([(1, "a", 5, "x")], LEFT), spark.createDataFrame([("a", 4, 1, "r")], RIGHT)
    assert rows(asof_join(left, right.limit(0), ["k"], "t")) == [(1, "a", 5, "x", None, None, None)]
    assert rows(asof_join(left.limit(0), right, ["k"], "t")) == []


def test_observation_times(spark):
    texts = ["2024-05-01T10:15", "2024-05-01T10:15:30", "2024-05-01", "soon", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_seconds(observation_time(F.col("t"))))
    assert [r[0] for r in found.collect()] == [1714558500, 1714558530, 1714521600, None, None]


def test_weather_meets_the_air_quality_of_the_hour(spark):
    weather = spark.createDataFrame(
        [("x", (f"2024-05-01T{h:02}:{m:02}", float(h * 100 + m))) for h in (10, 11) for m in (0, 15, 30, 45)] + [("y", ("2024-05-01T10:00", 1.0)), (None, ("t", 9.0))],
        "location string, current struct<time: string, temperature_2m: double>",
    )
    air = spark.createDataFrame(
        [("x", ("2024-05-01T10:00", 1.0)), ("x", ("2024-05-01T11:00", 2.0)), ("x", ("2024-05-01T11:00", 2.0)), (None, ("t", 3.0))],
        "location string, current struct<time: string, european_aqi: double>",
    )
    full_weather = weather.withColumn("current", F.expr(
        "named_struct('time', current.time, 'temperature_2m', current.temperature_2m, 'relative_humidity_2m', 0D, 'wind_speed_10m', 0D, 'rain', 0D, 'weather_code', 0)"))
    full_air = air.withColumn("current", F.expr(
        "named_struct('time', current.time, 'european_aqi', current.european_aqi, 'pm2_5', 0D, 'pm10', 0D, 'ozone', 0D)"))
    merged = merge_conditions(full_weather, full_air).select("location", "observed", "european_aqi")
    expected = [("x", f"2024-05-01T{h:02}:{m:02}", h - 9.0) for h in (10, 11) for m in (0, 15, 30, 45)]
    assert rows(merged) == sorted([*expected, ("y", "2024-05-01T10:00", None), (None, "t", 3.0)], key=repr)
    strict = merge_conditions(full_weather, full_air, tolerance=F.expr("interval 20 minutes"))
    assert strict.filter("european_aqi is not null").count() == 5
