"""Every acceptance query beside its SQL twin on the smallest tables."""

import pytest

import __spark_entry__
from acceptance.catalog import ORACLES, QUERIES
from acceptance.compare import differences, open_tables
from dwellrank.operators import ranking, skew, spatial
from dwellrank.plans import mart
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return open_tables(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert name in ORACLES
    assert differences(spark, connection, SMALL, name) is None


@pytest.mark.parametrize(
    "name", ["mart_stay_score", "win_rank_hot_values", "join_lookup_broadcast", "agg_size_by_category", "anti_unmatched"]
)
def test_large_data_paths_equal_sql(spark, connection, monkeypatch, name):
    """With every size limit at zero nothing is broadcast."""
    monkeypatch.setattr(ranking.attach_positions, "__defaults__", (0,))
    monkeypatch.setattr(skew.join_lookup, "__defaults__", (0,))
    monkeypatch.setattr(spatial.within_join, "__defaults__", (*spatial.within_join.__defaults__[:-1], 0))
    monkeypatch.setattr(mart, "MAX_BROADCAST_VALUES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(spark, connection, SMALL, name) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_entry_returns_the_mart(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.columns == [
        "neighbourhood",
        "value_score",
        "connectivity_score",
        "events_score",
        "stay_score",
        "overall_rank",
        "value_percentile",
        "connectivity_percentile",
        "stay_quartile",
        "connectivity_vs_avg",
        "value_vs_avg",
        "neighbourhood_type",
    ]
    ranks = [r.overall_rank for r in frame.collect()]
    assert ranks == sorted(ranks) and ranks


def test_contract_lists_every_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
