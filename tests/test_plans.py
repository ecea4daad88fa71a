"""Jobs on literal rows."""

import pytest
from pyspark.sql import functions as F

from dwellrank import schemas
from dwellrank.constants import LISTING_COLUMNS
from dwellrank.operators.checks import failing_accepted_values, failing_not_null, failing_unique, run_checks
from dwellrank.operators.joins import attach_group_total, one_row_per_key, station_areas
from dwellrank.operators.medians import count_and_lower_median, interpolated_median
from dwellrank.operators.skew import join_lookup
from dwellrank.plans import mart
from dwellrank.plans.connectivity import connectivity_scores, departures_by_hour, departures_with_location, station_counts
from dwellrank.plans.listings import clean_listings, listing_summary, value_scores
from tests.conftest import rows


@pytest.fixture(scope="module")
def transit(spark):
    times = (
        [("t", "de:11000:1:1", "08:00:00")] * 6
        + [("t", "de:11000:1:2", "25:10:00")] * 2
        + [("t", "de:11000:2:1", "09:00:00")] * 2
        + [("t", "de:11000:3:1", "10:00:00")] * 3
        + [("t", "de:12000:9:1", "08:00:00"), ("t", "de:11000:1:1", ""), ("t", "de:11000:1:1", None), ("t", "de:11000:77:1", "8:00")]
    )
    lookup = [
        ("de:11000:1:1", "A"),
        ("de:11000:1:2", "A"),
        ("de:11000:2:1", "B"),
        ("de:11000:3:1", "C"),
        ("odd", "C"),
        ("de:11000:5:1", "D"),
    ]
    areas = [("A", "2.0"), ("B", "4.0"), ("C", "0"), ("D", "1.0")]
    return (
        spark.createDataFrame(times, schemas.STOP_TIMES),
        spark.createDataFrame(lookup, schemas.STOP_LOOKUP),
        spark.createDataFrame(areas, schemas.AREA_SIZES),
    )


def test_connectivity(transit):
    # A: 8 departures, 1 station, 2 km2; B: 2, 1, 4; C: 3, 2 (one blank), 0 km2; D has no departures.
    found = rows(connectivity_scores(*transit))
    assert found == [("A", 8, 1, 2.0, 100.0), ("B", 2, 1, 4.0, 3.9), ("C", 3, 2, 0.0, None)]


def test_log_density(transit):
    plain = dict((r[0], r[-1]) for r in rows(connectivity_scores(*transit, detail=True).select("neighbourhood", "density.per_km2")))
    logged = connectivity_scores(*transit, density_transform="log1p", detail=True)
    for name, value in rows(logged.select("neighbourhood", "density.per_km2")):
        if value is not None:
            import math

            assert value == pytest.approx(math.log1p(plain[name]))
    with pytest.raises(ValueError):
        connectivity_scores(*transit, density_transform="sqrt")


def test_hours_and_stations(transit):
    assert rows(departures_by_hour(transit[0], transit[1])) == [("A", 1, 2), ("A", 8, 6), ("B", 9, 2), ("C", 10, 3)]
    assert rows(station_counts(transit[1])) == [("A", 1), ("B", 1), ("C", 2), ("D", 1)]


def test_duplicate_stops_do_not_multiply(spark, transit):
    stops = spark.createDataFrame([("de:11000:1:1", "52.5", "13.4")] * 3, schemas.STOPS)
    located = departures_with_location(transit[0], stops)
    assert located.agg(F.sum("departures")).first()[0] == 14
    assert located.filter(F.col("lat").isNotNull()).select("departures", "lat", "lon").collect() == [(6, 52.5, 13.4)]


def listing(price, area="A"):
    row = dict.fromkeys(LISTING_COLUMNS)
    return tuple({**row, "id": 1, "price": price, "neighbourhood_cleansed": area}.values())


def test_clean_listings(spark):
    prices = ["$1,234.00", "$10.00", "$1,000.00", "$9.99", "n/a", None]
    raw = spark.createDataFrame([listing(p) for p in prices], schemas.RAW_LISTINGS).withColumn("extra", F.lit(1))
    clean = clean_listings(raw)
    assert clean.columns == list(LISTING_COLUMNS)
    assert [r.price for r in clean.collect()] == [None, 10.0, 1000.0, None, None, None]
    assert rows(listing_summary(clean)) == [(6, 2, 1)]


def test_value_score_threshold_and_inversion(spark):
    data = [listing(f"${p}.00", "cheap") for p in range(20, 50)]
    data += [listing(f"${p}.00", "dear") for p in range(200, 230)]
    data += [listing(f"${p}.00", "middle") for p in range(110, 140)]
    data += [listing("$15.00", "few")] * 29 + [listing(None, "few")] * 10
    clean = clean_listings(spark.createDataFrame(data, schemas.RAW_LISTINGS))
    assert rows(value_scores(clean)) == [
        ("cheap", 30, 34.0, 100.0),
        ("dear", 30, 214.0, 0.0),
        ("middle", 30, 124.0, 50.0),
    ]
    assert {r[0] for r in rows(value_scores(clean, min_listings=29))} == {"cheap", "dear", "middle", "few"}


def test_medians(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", 7.0), ("b", None), ("c", None)], "k string, v double")
    assert rows(count_and_lower_median(df, "k", "v")) == [("a", 4, 2.0), ("b", 1, 7.0)]
    assert rows(interpolated_median(df.filter("k = 'a'"), "v", "m")) == [(2.5,)]


def test_joins(spark):
    lookup = spark.createDataFrame(
        [("de:1:2:b", "later"), ("de:1:2:a", "first"), ("bad", "x"), ("de:1:3", "other")], schemas.STOP_LOOKUP
    )
    assert rows(station_areas(lookup)) == [("de:1:2", "first"), ("de:1:3", "other")]
    counts = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 5)], "k string, c string, n long")
    assert rows(attach_group_total(counts, "k", "n", "t")) == [("a", "x", 1, 3), ("a", "y", 2, 3), ("b", "x", 5, 5)]
    assert one_row_per_key(counts, "k").count() == 2


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_join_with_a_hot_key(spark, limit):
    keys = ["hot"] * 200 + [f"k{i}" for i in range(100)] + [None] * 5 + ["unknown"] * 3
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    lookup = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(120)], "k string, v string")
    assert rows(join_lookup(facts, lookup, "k", limit)) == rows(facts.join(lookup, "k").select("i", "k", "v"))


def scores(spark, name, data):
    return spark.createDataFrame(data, f"neighbourhood string, {name} double")


def test_mart_joins_and_ranks(spark):
    value = scores(spark, "value_score", [("A", 100.0), ("B", 50.0), ("C", 50.0), ("D", 0.0), ("E", 10.0), ("F", None)])
    connectivity = scores(
        spark, "connectivity_score", [("A", 100.0), ("B", 20.0), ("C", 20.0), ("D", 90.0), ("E", None), ("F", 5.0)]
    )
    events = scores(spark, "events_score", [("A", 40.0), ("X", 1.0)])
    found = mart.stay_score_mart(value, connectivity, events)
    table = {r.neighbourhood: r for r in found.collect()}
    assert [r.neighbourhood for r in found.collect()] == ["A", "D", "B", "C", "F"]
    assert "E" not in table
    assert (table["A"].events_score, table["B"].events_score) == (40.0, 0.0)
    assert {k: r.overall_rank for k, r in table.items()} == {"A": 1, "D": 2, "B": 3, "C": 3, "F": 5}
    assert {k: r.stay_quartile for k, r in table.items()} == {"A": 1, "D": 1, "B": 2, "C": 3, "F": 4}
    assert table["A"].neighbourhood_type == "Hidden Gem"
    assert table["D"].neighbourhood_type == "Premium / Central"
    assert table["F"].stay_score is None
    assert table["A"].value_vs_avg == 50.0
    assert rows(mart.mart_checks(found)) == [
        ("accepted_values", "neighbourhood_type", 0),
        ("not_null", "neighbourhood", 0),
        ("not_null", "neighbourhood_type", 0),
        ("not_null", "stay_score", 1),
        ("unique", "neighbourhood", 0),
    ]


def test_mart_weights(spark):
    value, connectivity = scores(spark, "value_score", [("A", 60.0)]), scores(spark, "connectivity_score", [("A", 20.0)])
    events = scores(spark, "events_score", [("A", 10.0)])
    assert mart.scored_areas(value, connectivity, events, (0.2, 0.3, 0.5)).first().stay_score == 23.0


def test_area_type_compares_rounded_percentiles(spark):
    data = [(0.6, 0.6), (0.39, 0.6), (0.6, 0.39), (0.4, 0.6), (0.5, 0.5), (0.6, 0.4)]
    df = spark.createDataFrame(data, "v double, c double")
    assert [r[0] for r in df.select(mart.area_type(F.col("v"), F.col("c"))).collect()] == [
        "Hidden Gem",
        "Premium / Central",
        "Budget / Remote",
        "Balanced",
        "Balanced",
        "Balanced",
    ]


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3), (None, 4)], "k string, v int")
    assert rows(failing_unique(df, "k")) == [("a", 2)]
    assert rows(failing_not_null(df, "v")) == [("b", None)]
    assert rows(failing_accepted_values(df, "k", ["a"])) == [("b", 1)]
    assert rows(run_checks(df, unique=("k",), not_null=("v", "k"), accepted={"k": ("a",)})) == [
        ("accepted_values", "k", 1),
        ("not_null", "k", 2),
        ("not_null", "v", 1),
        ("unique", "k", 1),
    ]
