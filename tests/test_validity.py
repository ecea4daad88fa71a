"""Well-known text read back, and geometries that have no inside."""

import math
import random

import pytest
from pyspark.sql import functions as F

from dwellrank import jobs
from dwellrank.functions.geometry import from_wkt, to_wkt, wkt_type
from dwellrank.operators import validity
from dwellrank.operators.validity import with_validity
from dwellrank.plans.geometry import area_geometry_from_text
from tests.conftest import rows

SQUARE = "0 0, 4 0, 4 4, 0 4, 0 0"
TEXTS = [
    (f"POLYGON (({SQUARE}))", True),
    (f"polygon(({SQUARE}),(1 1,2 1,2 2,1 2,1 1))", True),
    (" MultiPolygon( ( (0 0, -1e1 .5 , 1. +4 ,0 0) ) ) ", True),
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((2 2, 3 2, 3 3, 2 2)))", True),
    ("MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 8 1, 8 8, 1 8, 1 1)), ((2 2, 3 2, 3 3, 2 2)))", True),  # an island
    (f"POLYGON (({SQUARE}), (0 2, 1 1, 1 3, 0 2))", True),  # a hole that touches in one point
    ("POLYGON ((0 0, 4 0, 4 0, 4 4, 0 4, 0 0))", True),  # a vertex twice
    ("POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", False),  # a bow tie
    ("POLYGON ((0 0, 4 0, 4 4, 2 0, 0 4, 0 0))", False),  # touches itself
    ("POLYGON ((0 0, 4 0, 2 0, 4 4, 0 4, 0 0))", False),  # a spike
    (f"POLYGON (({SQUARE}), (5 5, 6 5, 6 6, 5 6, 5 5))", False),  # a hole outside
    (f"POLYGON (({SQUARE}), (3 3, 6 3, 6 6, 3 6, 3 3))", False),  # a hole across
    (f"POLYGON (({SQUARE}), (4 2, 3 3, 5 3, 4 2))", False),
    (f"POLYGON (({SQUARE}), (4 2, 5 3, 5 1, 4 2))", False),  # outside, touching
    (f"POLYGON (({SQUARE}), (1 1, 3 1, 3 3, 1 3, 1 1), (2 2, 2.5 2, 2.5 2.5, 2 2))", False),  # a hole in a hole
    ("MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0)), ((2 2, 3 2, 3 3, 2 2)))", False),  # one within another
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((0 0, 1 0, 1 -1, 0 0)))", False),  # a shared edge
    ("POLYGON ((0 0, 4 0, 4 4, 0 4, 1 1))", False),  # open
    (f"POLYGON (({SQUARE})", False),
    (f"POLYGON ({SQUARE})", False),
    (f"POLYGON (({SQUARE}))) ", False),
    (f"POLYGON (({SQUARE})) extra", False),
    (f"POLYGON (({SQUARE}),)", False),
    ("POLYGON EMPTY", False),
    ("POINT (1 1)", False),
    ("POLYGON ((0 0, 4 0, 4 x, 0 4, 0 0))", False),
    ("POLYGON ((0 0, 4 0, 4 1d, 0 4, 0 0))", False),
    ("POLYGON ((0 0 1, 4 0 1, 4 4 1, 0 0 1))", False),
    ("", False),
    (None, False),
]


def test_texts(spark):
    df = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(TEXTS)], "i int, t string, expected boolean")
    judged = with_validity(df.withColumn("geometry", from_wkt(F.col("t"))))
    assert judged.columns == ["i", "t", "expected", "geometry", "valid"]
    assert [r.t for r in judged.collect() if r.valid != r.expected] == []


def test_round_trip(spark):
    text = "MULTIPOLYGON (((0 0, 9.5 0, 9 9, 0 -0.25, 0 0), (1 1, 2 1, 2 2, 1 1)), ((20 2, 30 2, 30 3, 20 2)))"
    for t in (text, f"POLYGON (({SQUARE}))"):
        df = spark.createDataFrame([(t,)], "t string")
        back = df.select(to_wkt(from_wkt(F.col("t")), wkt_type(F.col("t"))))
        assert back.first()[0] == t


def crossing(a, b, c, d):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


@pytest.mark.parametrize("per_cell", [8, 0.25])
def test_random_rings_equal_all_pairs(spark, monkeypatch, per_cell):
    """Rings with no two edges on one line, in few and in many cells."""
    monkeypatch.setattr(validity, "EDGES_PER_CELL", per_cell)
    rng = random.Random(5)
    cases = []
    for i in range(120):
        n = rng.randint(3, 12)
        wild = i % 2
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        points = [(math.cos(a) * rng.uniform(0.2, 3), math.sin(a) * rng.uniform(0.2, 3)) for a in angles]
        if wild:
            rng.shuffle(points)
        edges = list(zip(points, points[1:] + points[:1]))
        crossed = any(crossing(*edges[p], *edges[q]) for p in range(n) for q in range(p))
        cases.append((i, [[[list(p) for p in [*points, points[0]]]]], not crossed))
    df = spark.createDataFrame(cases, "i int, geometry array<array<array<array<double>>>>, expected boolean")
    assert {r.expected for r in df.collect()} == {True, False}
    assert [r.i for r in with_validity(df).collect() if r.valid != r.expected] == []


def test_one_geometry_with_many_edges(spark):
    n = 4000
    star = [[math.cos(2 * math.pi * k / n) * (1 + 0.1 * (k % 2)), math.sin(2 * math.pi * k / n) * (1 + 0.1 * (k % 2))] for k in range(n)]
    star.append(star[0])
    tied = [list(p) for p in star]
    tied[10], tied[2000] = tied[2000], tied[10]
    df = spark.createDataFrame([(1, [[star]]), (2, [[tied]])], "i int, geometry array<array<array<array<double>>>>")
    assert rows(with_validity(df).select("i", "valid")) == [(1, True), (2, False)]


def test_job_reads_text_columns(spark, tmp_path):
    (tmp_path / "areas.csv").write_text(f'geometry_wkt,neighbourhood\n"POLYGON (({SQUARE}))",a\n"POLYGON ((0 0,\n4 4, 4 0, 0 4, 0 0))",b\n,c\n')
    jobs.main(["area-geometry-text", "--input", f"areas={tmp_path}/areas.csv", "--output", str(tmp_path / "out")], spark)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.select("neighbourhood", F.col("geometry").isNotNull())) == [("a", True), ("b", False), ("c", False)]
    assert area_geometry_from_text(found.limit(0)).count() == 0
