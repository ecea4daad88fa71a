"""Exact quantiles against sorting, and sketches that merge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from dwellrank.operators.quantiles import exact_quantiles
from dwellrank.operators.summaries import DISTINCT_ERROR, RANK_ERROR, merged_summaries, read_summaries, summaries
from tests.conftest import rows


def lower(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(round(p * len(ordered), 9)), 1) - 1]


def between(values, p):
    ordered, at = sorted(values), (len(values) - 1) * p
    low = math.floor(at)
    high = ordered[min(low + 1, len(ordered) - 1)]
    return ordered[low] + (high - ordered[low]) * (at - low)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    return {
        "wide": [rng.uniform(-1, 1) * 10 ** rng.uniform(-30, 30) for _ in range(3000)],
        "ties": [float(rng.choice([1, 1, 1, 1, 2, 3])) for _ in range(2000)],
        "one value": [7.5] * 1500,
        "skewed": [2.0**-k for k in range(900)] + [0.0] * 100,
        "small": [3.0, 1.0, 2.0],
        "single": [4.0],
        None: [float(k) for k in range(500)],
    }


@pytest.mark.parametrize("interpolated", [False, True])
def test_equals_sorting(spark, groups, interpolated):
    data = [(k, v) for k, values in groups.items() for v in values] + [("small", None), ("nothing", None)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.99, 1.0]
    found = exact_quantiles(df, "k", "v", probabilities, [f"q{i}" for i in range(5)], interpolated, small=40)
    by = {r.k: tuple(r)[1:] for r in found.collect()}
    assert set(by) == set(groups)
    rule = between if interpolated else lower
    for k, values in groups.items():
        assert by[k][0] == len(values)
        assert list(by[k][1:]) == [pytest.approx(rule(values, p), rel=1e-12, abs=0) for p in probabilities]


def test_one_row_without_a_key(spark):
    df = spark.range(0, 1001).selectExpr("cast(id * id as double) as v")
    assert rows(exact_quantiles(df, None, "v", [0.5], ["median"], small=10)) == [(1001, 250000.0)]
    assert rows(exact_quantiles(df.filter("v < 0"), None, "v", [0.5], ["median"])) == []


def test_sketches_merge_within_their_bounds(spark):
    df = spark.range(0, 60000).selectExpr("id % 10 as day", "id % 7919 as user", "cast((id * 7919) % 60000 as double) as price")
    stored = summaries(df, ["day"], ["user"], ["price"])
    halves = merged_summaries(merged_summaries(stored.withColumn("half", F.col("day") % 2), ["half"]).drop("half"), [])
    direct = merged_summaries(stored.drop("day"), [])
    for merged in (halves, direct):
        found = read_summaries(merged, [0.1, 0.5]).first()
        assert found.n_rows == 60000 and abs(found.user_distinct - 7919) <= DISTINCT_ERROR * 7919
        assert [abs(q / 60000 - p) <= RANK_ERROR for q, p in zip(found.price_quantiles, (0.1, 0.5))] == [True, True]


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, 1.5)], "day int, user int, price double")
    stored = summaries(df, ["day"], ["user"], ["price"])
    found = {r.day: (r.n_rows, r.user_distinct) for r in read_summaries(merged_summaries(stored, ["day"]).drop("price_quantiles"), []).collect()}
    assert found == {1: (1, 0), 2: (1, 1)}
    assert summaries(df.limit(0), ["day"], ["user"], ["price"]).count() == 0
