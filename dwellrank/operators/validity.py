"""Geometries whose rings cross or lie outside each other.

Whether two edges of a geometry meet is found by a join: each edge is dealt to the cells that it passes of a grid
over its geometry, with as many cells as there are edges in some, so that only neighbours are compared and a
geometry with most of the edges spreads over its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.geometry import bounds, is_valid, ring_edges, strictly_within
from dwellrank.session import pin

EDGES_PER_CELL = 8
MAX_CELLS = 1024  # along each side of a geometry


def _turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Positive, zero or negative as c lies left of, on, or right of the line from a to b."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _edges(geometries: DataFrame) -> DataFrame:
    """One row per edge with its place (polygon, ring, number) and its ring's size; edges of no length left out."""
    some_length = lambda e: (e.x1 != e.x2) | (e.y1 != e.y2)
    return (
        geometries.select("_id", "_b", "_cells", F.posexplode("geometry").alias("_polygon", "_rings"))
        .select("_id", "_b", "_cells", "_polygon", F.posexplode("_rings").alias("_ring", "_r"))
        .withColumn("_e", F.filter(ring_edges(F.col("_r")), some_length))
        .select("_id", "_b", "_cells", "_polygon", "_ring", F.size("_e").alias("_n"), F.posexplode("_e").alias("_i", "_edge"))
        .select("_id", "_b", "_cells", F.struct("_polygon", "_ring").alias("ring"), F.col("_n").alias("n"), F.col("_i").alias("i"), "_edge.*")
    )


def _in_cells(edges: DataFrame) -> DataFrame:
    """Edges with the cells they pass: by column, and in each column the rows between its two ends there."""
    width = F.greatest(F.col("_b.max_x") - F.col("_b.min_x"), F.col("_b.max_y") - F.col("_b.min_y")) / F.col("_cells")
    sized = edges.withColumn("_w", F.greatest(width * (1 + 1e-9), F.lit(1e-300)))

    def place(value: Column, low: str) -> Column:
        return F.floor((value - F.col(f"_b.{low}")) / F.col("_w")).cast("int")

    # An edge on the border of two cells is in both: ends are widened by a small part of a cell.
    slack = F.col("_w") * 1e-6
    low_x, high_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    columns = sized.withColumn("cx", F.explode(F.sequence(place(low_x - slack, "min_x"), place(high_x + slack, "min_x"))))
    from_x = F.greatest(low_x, F.col("_b.min_x") + F.col("cx") * F.col("_w") - slack)
    to_x = F.least(high_x, F.col("_b.min_x") + (F.col("cx") + 1) * F.col("_w") + slack)

    def at(x: Column) -> Column:
        return F.col("y1") + F.coalesce(F.try_divide((x - F.col("x1")) * (F.col("y2") - F.col("y1")), F.col("x2") - F.col("x1")), F.lit(0.0))

    upright = F.col("x1") == F.col("x2")
    one, two = F.when(upright, F.col("y1")).otherwise(at(from_x)), F.when(upright, F.col("y2")).otherwise(at(to_x))
    rows = F.sequence(place(F.least(one, two) - slack, "min_y"), place(F.greatest(one, two) + slack, "min_y"))
    return columns.withColumn("cy", F.explode(rows)).select("_id", "cx", "cy", "ring", "n", "i", "x1", "y1", "x2", "y2")


def _meeting() -> tuple[Column, Column]:
    """Whether edges a and b share a point that calls for a decision, and whether they may not be in one geometry."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    o1 = _turn(a("x1"), a("y1"), a("x2"), a("y2"), b("x1"), b("y1"))
    o2 = _turn(a("x1"), a("y1"), a("x2"), a("y2"), b("x2"), b("y2"))
    o3 = _turn(b("x1"), b("y1"), b("x2"), b("y2"), a("x1"), a("y1"))
    o4 = _turn(b("x1"), b("y1"), b("x2"), b("y2"), a("x2"), a("y2"))

    def shared(p: str, q: str) -> tuple[Column, Column]:
        return F.greatest(F.least(a(p), a(q)), F.least(b(p), b(q))), F.least(F.greatest(a(p), a(q)), F.greatest(b(p), b(q)))

    (x_low, x_high), (y_low, y_high) = shared("x1", "x2"), shared("y1", "y2")
    along = (o1 == 0) & (o2 == 0) & ((x_low < x_high) | (y_low < y_high))
    same = a("ring") == b("ring")
    step = F.abs(a("i") - b("i"))
    neighbours = same & ((step == 1) | (step == a("n") - 1))
    # The cheapest conditions first: most pairs of a cell do not overlap in x and y.
    meet = (x_low <= x_high) & (y_low <= y_high) & (o1 * o2 <= 0) & (o3 * o4 <= 0) & (~neighbours | along)
    return meet, same | along | ((o1 * o2 < 0) & (o3 * o4 < 0))


def _midpoints(ring: Column) -> Column:
    return F.transform(ring_edges(ring), lambda e: F.struct(((e.x1 + e.x2) / 2).alias("x"), ((e.y1 + e.y2) / 2).alias("y")))


def _ring_inside(ring: Column, rings: Column) -> Column:
    """Whether a ring that crosses none of ``rings`` lies within them: some midpoint of an edge does."""
    edges = F.array(F.flatten(F.transform(rings, ring_edges)))
    return F.exists(_midpoints(ring), lambda p: strictly_within(p.x, p.y, edges))


def _well_nested() -> Column:
    """Holes lie in their outline and in no other hole, and no polygon lies in another one."""
    geometry = F.col("geometry")

    def holes_fit(polygon: Column) -> Column:
        outline, holes = F.slice(polygon, 1, 1), F.slice(polygon, 2, F.size(polygon))
        inside = F.forall(holes, lambda hole: _ring_inside(hole, outline))
        apart = F.forall(
            F.transform(holes, lambda hole, i: F.exists(F.transform(holes, lambda other, j: (i != j) & _ring_inside(hole, F.array(other))), lambda x: x)),
            lambda nested: ~nested,
        )
        return inside & apart

    nested = F.transform(
        geometry,
        lambda polygon, i: F.exists(
            F.transform(geometry, lambda other, j: (i != j) & _ring_inside(F.get(polygon, F.lit(0)), other)), lambda x: x
        ),
    )
    return F.forall(geometry, holes_fit) & F.forall(nested, lambda x: ~x)


def with_validity(areas: DataFrame, name: str = "valid") -> DataFrame:
    """``areas`` with whether their ``geometry`` is one that has an inside and an outside.

    False for null, for rings that are open, short or not finite, for rings that touch or cross themselves,
    for rings of one geometry that cross or share a piece of an edge, for holes outside their outline or in another
    hole, and for polygons within another. Rings may touch in single points; then the side on which a ring lies
    is asked of all its edges, else of the first that tells.
    """
    numbered = pin(areas.withColumn("_id", F.monotonically_increasing_id()), "geometries")
    count = F.aggregate("geometry", F.lit(0), lambda acc, p: acc + F.aggregate(p, F.lit(0), lambda n, r: n + F.size(r)))
    cells = F.least(F.greatest(F.ceil(F.sqrt(count / EDGES_PER_CELL)), F.lit(1)), F.lit(MAX_CELLS)).cast("int")
    shaped = numbered.filter(is_valid(F.col("geometry"))).select("_id", "geometry", bounds(F.col("geometry")).alias("_b"), cells.alias("_cells"))
    dealt = _in_cells(_edges(shaped))
    meet, conflict = _meeting()
    a, b = dealt.alias("a"), dealt.alias("b")
    first = (F.col("a.i") < F.col("b.i")) | ((F.col("a.i") == F.col("b.i")) & (F.col("a.ring") < F.col("b.ring")))
    cell = (F.col("a._id") == F.col("b._id")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    found = a.join(b, cell & first & meet).groupBy(F.col("a._id").alias("_id")).agg(F.max(conflict).alias("_crossed"))
    # Only a ring that touches another can have edges on both of its sides without crossing one.
    sides = F.forall("geometry", lambda p: F.forall(F.slice(p, 2, F.size(p)), lambda h: _all_inside(h, F.slice(p, 1, 1))))
    judged = (
        shaped.select("_id", "geometry").join(found, "_id", "left")
        .select("_id", F.when(F.col("_crossed"), False).when(~_well_nested(), False).otherwise(F.col("_crossed").isNull() | sides).alias(name))
    )
    others = [c for c in areas.columns if c != name]
    return numbered.join(judged, "_id", "left").select(*others, F.coalesce(name, F.lit(False)).alias(name))


def _all_inside(ring: Column, rings: Column) -> Column:
    """Whether no midpoint of an edge lies outside; one on the boundary does not."""
    edges = F.array(F.flatten(F.transform(rings, ring_edges)))
    reach = lambda p, d: strictly_within(p.x + d, p.y, edges) | strictly_within(p.x - d, p.y, edges) | strictly_within(p.x, p.y + d, edges) | strictly_within(p.x, p.y - d, edges)
    return F.forall(_midpoints(ring), lambda p: strictly_within(p.x, p.y, edges) | reach(p, F.abs(p.x) * 1e-12 + 1e-12))
