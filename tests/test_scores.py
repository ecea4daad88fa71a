"""Min-max scores, ranks and windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwellrank.operators import ranking
from dwellrank.operators.scaling import mean_score, with_delta_from_mean, with_minmax_scores
from dwellrank.session import pin
from tests.conftest import rows


def numbers(spark, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], "k int, v double")


def test_minmax_ends_and_inversion(spark):
    df = numbers(spark, [10.0, 20.0, 15.0, None])
    assert rows(with_minmax_scores(df, {"v": "s"}).select("k", "s")) == [(0, 0.0), (1, 100.0), (2, 50.0), (3, None)]
    assert rows(with_minmax_scores(df, {"v": "s"}, invert=True).select("k", "s")) == [
        (0, 100.0),
        (1, 0.0),
        (2, 50.0),
        (3, None),
    ]


def test_minmax_of_equal_values_is_null(spark):
    df = numbers(spark, [5.0, 5.0])
    assert rows(with_minmax_scores(df, {"v": "s"}).select("s")) == [(None,), (None,)]


def test_mean_score_rounds_the_rounded(spark):
    df = spark.createDataFrame([(33.5, 34.0), (10.0, 20.1), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(mean_score("a", "b")).collect()] == [33.8, 15.1, None]


def test_delta_from_mean(spark):
    assert rows(with_delta_from_mean(numbers(spark, [1.0, 2.0, 6.0]), {"v": "d"}).select("k", "d")) == [
        (0, -2.0),
        (1, -1.0),
        (2, 3.0),
    ]


TIED = [3.0, 1.0, 2.0, 2.0, None, 2.0, 9.5, 9.5, -1.0, None]


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_window_rank(spark, monkeypatch, limit, descending):
    monkeypatch.setattr(ranking.attach_positions, "__defaults__", (limit,))
    df = numbers(spark, TIED * 7)
    order = F.col("v").desc() if descending else F.col("v").asc()
    expected = df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("long"))
    assert rows(ranking.with_rank(df, "v", "r", descending)) == rows(expected)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_rank_with_one_value_holding_most_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(ranking.attach_positions, "__defaults__", (limit,))
    df = numbers(spark, [7.0] * 400 + [float(i) for i in range(300)])
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())).cast("long"))
    assert rows(ranking.with_rank(df, "v", "r")) == rows(expected)


def test_percent_rank(spark):
    df = numbers(spark, TIED)
    expected = df.withColumn("p", F.round(F.percent_rank().over(Window.orderBy("v")), 2))
    assert rows(ranking.with_percent_rank(df, "v", "p")) == rows(expected)


def test_percent_rank_of_one_row(spark):
    assert rows(ranking.with_percent_rank(numbers(spark, [4.0]), "v", "p")) == [(0, 4.0, 0.0)]


@pytest.mark.parametrize("k", [1, 4, 7, 100])
def test_ntile_equals_window_ntile(spark, k):
    df = numbers(spark, [float(i % 5) for i in range(53)]).repartition(5)
    order = [F.col("v").desc(), F.col("k").asc()]
    expected = df.withColumn("q", F.ntile(k).over(Window.orderBy(*order)))
    assert rows(ranking.with_ntile(df, k, order, "q")) == rows(expected)


def test_row_number_on_many_partitions(spark):
    df = spark.range(20_000).select(F.col("id"), (F.xxhash64("id") % 13).alias("g"))
    order = [F.col("g").asc(), F.col("id").desc()]
    expected = df.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("long"))
    got = ranking.with_row_number(df, order, "n", "total")
    assert got.select("total").distinct().collect() == [(20_000,)]
    assert got.drop("total").exceptAll(expected).isEmpty()


def test_rank_on_many_range_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = pin(spark.range(30_000).select(F.col("id"), (F.xxhash64("id") % 5000).cast("double").alias("v")))
        expected = df.withColumn("r", F.rank().over(Window.orderBy("v")).cast("long"))
        positions = ranking.value_positions(df, ["v"])
        assert positions.n_values == df.select("v").distinct().count()
        got = ranking.with_rank(df, "v", "r", descending=False, positions=positions)
        assert got.exceptAll(expected).isEmpty() and got.count() == 30_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_positions_of_several_measures(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (2.0, None)], "a double, b double")
    table = ranking.value_positions(df, ["a", "b"]).table
    assert rows(table.filter("measure = 0")) == [(0, 1.0, 0, 1, 3), (0, 2.0, 1, 2, 3)]
    assert rows(table.filter("measure = 1")) == [(1, 5.0, 1, 2, 3), (1, None, 0, 1, 3)]


def test_neighbouring_large_integers_get_their_own_ranks(spark):
    df = spark.createDataFrame([(i, 2**53 + i) for i in range(4)], "k int, v long")
    assert rows(ranking.with_rank(df, "v", "r", descending=False)) == [(i, 2**53 + i, i + 1) for i in range(4)]
    mixed = spark.createDataFrame([(1, 2.5), (2, 0.5)], "a long, b double")
    assert rows(ranking.value_positions(mixed, ["a", "b"]).table.select("measure", "value", "n_below")) == [
        (0, 1.0, 0), (0, 2.0, 1), (1, 0.5, 0), (1, 2.5, 1),
    ]


def test_row_number_of_no_rows(spark):
    empty = numbers(spark, [])
    assert ranking.with_row_number(empty, [F.col("k").asc()], "n").count() == 0
