"""Joins that move only rows whose key may be found."""

import pytest
from pyspark.sql import functions as F

from dwellrank.operators.joins import possible_keys, with_keys, without_keys
from dwellrank.session import pin


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_keys_are_split_exactly_and_few_others_move(spark, no_broadcast, n):
    rows = spark.range(10_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("text").alias("t"))
    rows = rows.unionByName(rows.filter("k in (7, 9, 11)"))
    keys = pin(spark.range(n).select((20 * F.col("id") + 7).alias("k")))
    wanted = [20 * i + 7 for i in range(n)]
    inside = sorted(r.k for r in with_keys(rows, keys, "k").collect())
    assert inside == sorted(wanted + [7] * (n > 0))
    outside = without_keys(rows, keys, "k")
    assert outside.columns == rows.columns
    found = [r.k for r in outside.collect()]
    assert found.count(None) == 1 and len(found) + len(inside) == rows.count() and not set(found) & set(wanted)
    moved = rows.filter(possible_keys(keys, "k")(F.col("k"))).count()
    assert len(inside) <= moved <= len(inside) + 10_000 / 16


def test_struct_keys_with_null_in_them(spark, no_broadcast):
    rows = spark.createDataFrame([("a", None), ("a", 1), ("b", None), ("b", 2)], "h string, i long").withColumn("k", F.struct("h", "i"))
    keys = pin(rows.filter("h = 'a' and i is null or i = 2").select("k"))
    assert sorted(with_keys(rows, keys, "k").select("h", "i").collect(), key=repr) == [("a", None), ("b", 2)]
    assert sorted(without_keys(rows, keys, "k").select("h", "i").collect(), key=repr) == [("a", 1), ("b", None)]
