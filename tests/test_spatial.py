"""Point-in-polygon cases, the grid join against brute force, geometry text, validity and area."""

import random

import pytest
from pyspark.sql import functions as F

from dwellrank.functions.geometry import GEOMETRY_TYPE, area_km2, is_valid, polygon_edges, strictly_within, to_wkt
from dwellrank.operators import spatial
from dwellrank.operators.skew import with_salts
from dwellrank.operators.spatial import area_cells, count_unmatched, within_join
from dwellrank.plans.events import area_event_counts, events_by_category, events_scores
from dwellrank.plans.geometry import area_sizes, stop_lookup
from tests.conftest import rows


def ring(*points):
    closed = list(points) + [points[0]]
    return [[float(x), float(y)] for x, y in closed]


SQUARE = ring((0, 0), (10, 0), (10, 10), (0, 10))
HOLE = ring((4, 4), (6, 4), (6, 6), (4, 6))
NOTCHED = ring((20, 0), (30, 0), (30, 10), (25, 2), (20, 10))
OVERLAP = ring((8, 8), (22, 8), (22, 12), (8, 12))
AREAS = [
    ("framed", [[SQUARE, HOLE]]),
    ("notched", [[NOTCHED]]),
    ("overlap", [[OVERLAP]]),
    ("parts", [[ring((40, 0), (42, 0), (42, 2))], [ring((50, 0), (52, 0), (52, 2), (50, 2))]]),
]


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame(AREAS, f"neighbourhood string, geometry {GEOMETRY_TYPE}")


def located(spark, points):
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, longitude double, latitude double"
    )


CASES = [
    ((1, 1), {"framed"}),
    ((5, 5), set()),  # in the hole
    ((4, 5), set()),  # on the hole's edge
    ((4, 4), set()),  # on the hole's corner
    ((0, 0), set()),  # on a corner
    ((10, 5), set()),  # on an edge
    ((5, 0), set()),  # on a horizontal edge
    ((9, 9), {"framed", "overlap"}),
    ((9, 10), {"overlap"}),  # on the edge of one, inside the other
    ((25, 1), {"notched"}),
    ((25, 5), set()),  # in the notch
    ((25, 2), set()),  # on the notch's corner
    ((41.5, 0.5), {"parts"}),
    ((51, 1), {"parts"}),
    ((45, 1), set()),
    ((-3, 5), set()),
    ((100, 100), set()),
]


@pytest.mark.parametrize("cell_size", [None, 0.7, 100.0])
@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_hand_checked_points(spark, areas, cell_size, limit):
    points = located(spark, [p for p, _ in CASES])
    joined = within_join(points, areas, "left", cell_size=cell_size, max_broadcast_edges=limit)
    found = {}
    for r in joined.collect():
        found.setdefault(r.id, set())
        if r.neighbourhood is not None:
            found[r.id].add(r.neighbourhood)
    assert found == {i: expected for i, (_, expected) in enumerate(CASES)}


def test_left_join_keeps_each_unmatched_point_once(spark, areas):
    points = located(spark, [p for p, _ in CASES])
    joined = within_join(points, areas, "left")
    assert joined.filter(F.col("neighbourhood").isNull()).count() == sum(not e for _, e in CASES)
    assert rows(count_unmatched(points, areas, "n")) == [(sum(not e for _, e in CASES),)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_grid_equals_brute_force(spark, limit):
    rng = random.Random(7)
    shapes = []
    for i in range(40):
        x, y, n = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.randint(3, 9)
        corners = [(x + rng.uniform(-2, 2), y + rng.uniform(-2, 2)) for _ in range(n)]
        shapes.append((f"a{i}", [[ring(*corners)]]))
    areas = spark.createDataFrame(shapes, f"neighbourhood string, geometry {GEOMETRY_TYPE}")
    # A third of the points share one cell and place.
    spots = [(rng.uniform(-7, 7), rng.uniform(-7, 7)) for _ in range(600)] + [(0.25, 0.25)] * 300
    points = located(spark, spots)
    brute = (
        points.crossJoin(areas.withColumn("edges", polygon_edges(F.col("geometry"))))
        .filter(strictly_within(F.col("longitude"), F.col("latitude"), F.col("edges")))
        .select("id", "neighbourhood")
    )
    grid = within_join(points, areas, "inner", max_broadcast_edges=limit).select("id", "neighbourhood")
    assert rows(grid) == rows(brute)


def test_two_features_of_one_area_count_twice(spark):
    twice = spark.createDataFrame([("a", [[SQUARE]]), ("a", [[SQUARE]])], f"neighbourhood string, geometry {GEOMETRY_TYPE}")
    assert within_join(located(spark, [(1, 1)]), twice, "inner").count() == 2


def squares(spark, *sides):
    shapes = [(f"s{i}", [[ring((0.1, 0.1), (0.1 + s, 0.1), (0.1 + s, 0.1 + s), (0.1, 0.1 + s))]]) for i, s in enumerate(sides)]
    return spark.createDataFrame(shapes, f"neighbourhood string, geometry {GEOMETRY_TYPE}")


def test_cells_of_an_area_do_not_depend_on_the_others(spark):
    sides = [1e-9, 0.001, 0.7, 1.0, 3.9, 4.0, 100.0, 1e6]
    counts = {r.neighbourhood: r["count"] for r in area_cells(squares(spark, *sides), "neighbourhood").groupBy("neighbourhood").count().collect()}
    assert set(counts) == {f"s{i}" for i in range(len(sides))} and max(counts.values()) <= 25
    assert area_cells(squares(spark, 1.0).limit(0), "neighbourhood").count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_areas_on_several_grids(spark, limit, how):
    areas = squares(spark, 0.5, 5.0, 500.0)
    points = located(spark, [(0.2, 0.2), (3, 3), (300, 300), (900, 900)])
    found = within_join(points, areas, how, max_broadcast_edges=limit).select("id", "neighbourhood")
    inside = [(0, "s0"), (0, "s1"), (0, "s2"), (1, "s1"), (1, "s2"), (2, "s2")]
    assert rows(found) == sorted(inside + [(3, None)] * (how == "left"), key=repr)
    assert rows(within_join(points, areas.limit(0), how).select("id")) == [(i,) for i in range(4)] * (how == "left")


def test_bad_geometry_spoils_no_other(spark):
    bad = [("inf", [[ring((0, 0), (float("inf"), 0), (1, 1))]]), ("nan", [[ring((0, 0), (float("nan"), 0), (1, 1))]]), ("none", None), ("open", [[[[0.0, 0.0], [1.0, 1.0]]]])]
    areas = squares(spark, 1.0).unionByName(spark.createDataFrame(bad, f"neighbourhood string, geometry {GEOMETRY_TYPE}"))
    assert rows(within_join(located(spark, [(0.5, 0.5), (7, 7)]), areas, "left").select("id", "neighbourhood")) == [(0, "s0"), (1, None)]


def test_equal_rows_get_different_salts(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    salted, repeated = with_salts(left, right, ["k"])
    assert salted.select("_salt").distinct().count() == repeated.count() > 1
    assert salted.join(repeated, ["k", "_salt"]).count() == 4000


def test_events_are_counted_and_scored(spark, areas):
    events = located(spark, [(1, 1), (1, 1), (2, 2), (9, 9), (25, 1), (5, 5)]).withColumn(
        "category", F.when(F.col("id") < 2, "music")
    )
    missing = spark.createDataFrame([(99, None, 1.0, None)], "id int, longitude double, latitude double, category string")
    events = events.unionByName(missing)
    assert rows(area_event_counts(events, areas)) == [("framed", 4), ("notched", 1), ("overlap", 1)]
    assert rows(events_scores(events, areas)) == [("framed", 4, 100.0), ("notched", 1, 0.0), ("overlap", 1, 0.0)]
    assert rows(events_by_category(events, areas)) == [
        ("framed", "Other", 2, 4),
        ("framed", "music", 2, 4),
        ("notched", "Other", 1, 1),
        ("overlap", "Other", 1, 1),
    ]


def test_stop_lookup(spark, areas):
    stops = spark.createDataFrame(
        [("s1", "1", "1"), ("s2", "5", "5"), ("s3", None, "1"), ("s4", "bad", "1")], "stop_id string, stop_lat string, stop_lon string"
    )
    assert rows(stop_lookup(stops, areas)) == [("s1", "framed")]


def test_well_known_text(spark):
    data = [
        ("Polygon", [[ring((0, 0), (1.5, 0), (1.5, -2.25))]]),
        ("Polygon", [[SQUARE, HOLE]]),
        ("MultiPolygon", [[ring((0, 0), (1, 0), (1, 1))]]),
        ("Polygon", [[ring((0.00001, 10), (1, 0), (1, 1))]]),
    ]
    df = spark.createDataFrame(data, f"t string, geometry {GEOMETRY_TYPE}")
    assert [r[0] for r in df.select(to_wkt(F.col("geometry"), F.col("t"))).collect()] == [
        "POLYGON ((0 0, 1.5 0, 1.5 -2.25, 0 0))",
        "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))",
        "POLYGON ((0.00001 10, 1 0, 1 1, 0.00001 10))",
    ]


def test_validity(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        ([[SQUARE]], True),
        ([[SQUARE, HOLE]], True),
        ([[SQUARE[:-1]]], False),
        ([[[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]], False),
        ([[[[0.0, 0.0], [1.0, nan], [1.0, 1.0], [0.0, 0.0]]]], False),
        ([[[[0.0, 0.0], [inf, 0.0], [1.0, 1.0], [0.0, 0.0]]]], False),
        ([[[[0.0], [1.0], [1.0], [0.0]]]], False),
        ([[SQUARE], []], False),
        ([], False),
        (None, False),
    ]
    df = spark.createDataFrame(data, f"geometry {GEOMETRY_TYPE}, expected boolean")
    for r in df.select(is_valid(F.col("geometry")).alias("found"), "expected").collect():
        assert r.found == r.expected


def test_area_of_a_small_rectangle(spark):
    # 0.1 by 0.1 degrees at 52.5 north: 11.1195 km by 6.7691 km.
    box = ring((13.0, 52.45), (13.1, 52.45), (13.1, 52.55), (13.0, 52.55))
    hole = ring((13.02, 52.47), (13.07, 52.47), (13.07, 52.52), (13.02, 52.52))
    data = [("full", [[box]]), ("holed", [[box, hole]]), ("half", [[ring((13.0, 52.45), (13.1, 52.45), (13.1, 52.55))]])]
    df = spark.createDataFrame(data, f"neighbourhood string, geometry {GEOMETRY_TYPE}")
    found = dict(rows(df.select("neighbourhood", area_km2(F.col("geometry")))))
    assert found["full"] == pytest.approx(75.27, rel=0.001)
    assert found["holed"] == pytest.approx(75.27 * 0.75, rel=0.001)
    assert found["half"] == pytest.approx(75.27 / 2, rel=0.002)
    assert dict(rows(area_sizes(df)))["full"] == pytest.approx(75.27, rel=0.001)


def test_whole_hot_point_and_bad_polygon_queries_meet_every_square(spark, inputs):
    from acceptance.catalog import QUERIES
    from tests.conftest import SMALL

    events = [r.event_id for r in inputs.table("events").select("event_id").collect()]
    expected = {}
    for (key,) in inputs.table("supplier").select("s_suppkey").collect():
        x0, y0, side = 11 + (key % 7) * 15e-2, 48 + (key % 5) * 21e-2, (3e-1, 1e0, 3e0)[key % 3]
        n = sum(x0 < 12 + i % 3 * 1e-2 < x0 + side and y0 < 49 + i % 3 * 1e-2 < y0 + side for i in events)
        if n:
            expected[key] = n
    assert expected and dict(rows(QUERIES["spatial_within_hot_point_all"](spark, SMALL))) == expected
    whole = rows(QUERIES["spatial_within_bad_polygon_all"](spark, SMALL))
    assert whole == rows(QUERIES["spatial_within_many_areas"](spark, SMALL)) and max(area for area, _ in whole) >= 40


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("cell_size", [None, 3.0])
def test_counts_equal_pairs_when_crowded_cells_are_cut(spark, monkeypatch, limit, cell_size):
    monkeypatch.setattr(spatial, "MAX_CELL_PLACES", 3)
    rng = random.Random(11)
    shapes = [("framed", [[SQUARE, HOLE]]), ("framed", [[SQUARE, HOLE]]), ("parts", [[SQUARE], [OVERLAP]]), ("far", [[ring((90, 90), (91, 90), (91, 91))]])]
    for i in range(12):
        x, y = rng.uniform(-5, 5), rng.uniform(-5, 5)
        shapes.append((f"a{i}", [[ring(*[(x + rng.uniform(-6, 6), y + rng.uniform(-6, 6)) for _ in range(rng.randint(3, 8))])]]))
    areas = spark.createDataFrame(shapes, f"neighbourhood string, geometry {GEOMETRY_TYPE}")
    spots = [(rng.uniform(-9, 12), rng.uniform(-9, 12)) for _ in range(400)] + [(0.25, 0.25)] * 200
    spots += [(i, j) for i in range(0, 11, 2) for j in range(0, 11, 2)] + [(float("nan"), 1.0), (1.0, float("inf"))]
    points = located(spark, spots).unionByName(spark.createDataFrame([(-1, None, 1.0)], "id int, longitude double, latitude double"))
    pairs = within_join(points, areas, "left", cell_size=cell_size, max_broadcast_edges=limit)
    expected = rows(pairs.groupBy("neighbourhood").agg(F.count("*").alias("n")))
    for how in ("left", "inner"):
        counts = within_join(points, areas, how, cell_size=cell_size, counted="n", max_broadcast_edges=limit)
        found = rows(counts.groupBy("neighbourhood").agg(F.sum("n").alias("n")))
        assert found == [r for r in expected if how == "left" or r[0] is not None]
    assert rows(count_unmatched(points, areas, "n")) == [(dict(expected)[None],)]


def test_counts_without_areas_or_points(spark, areas):
    points = located(spark, [(1, 1), (5, 5)])
    left = within_join(points, areas.limit(0), "left", counted="n")
    assert rows(left) == [(None, 2)] and rows(within_join(points, areas.limit(0), "inner", counted="n")) == []
    assert rows(within_join(points.limit(0), areas, "left", counted="n")) == rows(within_join(points.limit(0), areas, "inner", counted="n")) == []
    assert rows(count_unmatched(points, areas.limit(0), "n")) == [(2,)] and rows(count_unmatched(points.limit(0), areas, "n")) == [(0,)]


def test_points_in_many_areas_are_counted_without_pairs(spark, monkeypatch):
    met = []
    meet = spatial._Counting.meet

    def counted(self, cells, places):
        met.append(meet(self, cells, places))
        return met[-1]

    monkeypatch.setattr(spatial._Counting, "meet", counted)
    shifted = [(f"s{i}", [[ring((0, 0), (40 + i, 0), (40 + i, 40 + i), (0, 40 + i))]]) for i in range(50)]
    areas = spark.createDataFrame(shifted, f"neighbourhood string, geometry {GEOMETRY_TYPE}")
    points = located(spark, [(1 + i / 20, 1 + j / 20) for i in range(20) for j in range(20)])
    # 20,000 pairs; every place lies in a cell that each square fills.
    assert rows(count_unmatched(points, areas, "n")) == [(0,)] and met.pop().count() == 0
    assert rows(within_join(points, areas, "left", counted="n")) == sorted([(f"s{i}", 400) for i in range(50)], key=repr)
    assert met[0].count() <= 20_000 / 2
