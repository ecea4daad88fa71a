"""Points in polygons through a hierarchy of grids.

Every polygon is cut into the cells of a grid whose size fits its own extent, each cell keeping only the
edges a test of a point in that cell can need. A key holds the level and the cell; a point has one key on
every level in use, and one join on keys runs the test on those few edges, inside the join condition, so no
(point, edge) pair is ever a row. The number of joins does not depend on the number of levels.

Where only numbers of points are asked for, no (point, area) pair becomes a row either. Cells that lie within
an area take the number of their points as it is. Cells that an outline passes are cut again while many places
lie in them, and only the places of the last ones are tested.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.geometry import bounds, is_valid, polygon_edges, strictly_within
from dwellrank.operators.skew import hot_slices, with_salts
from dwellrank.session import pin, pin_measured

STEP = 4  # a grid's cells are this many times as wide as those of the next finer one
FINEST = -20  # power of STEP; narrower polygons use this grid
MAX_BROADCAST_EDGES = 100_000  # about 6 MB in memory: the cells hold numbers only
MAX_CELL_PLACES = 32  # a cell with more places is cut into STEP * STEP cells where an outline passes it
MAX_CELL = 2**24  # beyond this number of a cell, the slack of a cell nears the precision of a double


def grid_level(extent: Column) -> Column:
    """The grid of a polygon: the largest power of ``STEP`` up to its extent, so it spans 25 cells at most."""
    exact = F.floor(F.log(float(STEP), F.greatest(extent, F.lit(float(STEP) ** FINEST))) + 1e-9)
    return F.greatest(exact, F.lit(FINEST)).cast("int")


def _cell(coordinate: Column, size: Column) -> Column:
    return F.floor(coordinate / size).cast("long")


def _kept(edges: Column, needed) -> Column:
    return F.filter(F.transform(edges, lambda ring: F.filter(ring, needed)), lambda ring: F.size(ring) > 0)


def _boxed(areas: DataFrame, key: str, cell_size: float | None) -> DataFrame:
    boxed = areas.select(key, polygon_edges(F.col("geometry")).alias("all_edges"), bounds(F.col("geometry")).alias("b"))
    extent = F.greatest(F.col("b.max_x") - F.col("b.min_x"), F.col("b.max_y") - F.col("b.min_y"))
    return boxed.withColumn("_level", F.lit(0) if cell_size else grid_level(extent))


def area_cells(areas: DataFrame, key: str, cell_size: float | None = None) -> DataFrame:
    """Rows (key, _level, _cx, _cy, edges): the edges each cell of an area can need.

    ``cell_size`` puts all areas on one grid of that size, level 0.
    """
    size = F.lit(cell_size) if cell_size else F.pow(F.lit(float(STEP)), F.col("_level"))
    leveled = _boxed(areas, key, cell_size).withColumn("_size", size)

    # Columns of cells first, then the cells of each column, from that column's edges.
    width, slack = F.col("_size"), F.col("_size") * 1e-6
    columns = leveled.withColumn("_cx", F.explode(F.sequence(_cell(F.col("b.min_x"), width), _cell(F.col("b.max_x"), width))))
    low_x = F.col("_cx") * width - slack
    columns = columns.withColumn("by_column", _kept("all_edges", lambda e: F.greatest(e.x1, e.x2) >= low_x)).drop("all_edges")
    cells = columns.withColumn("_cy", F.explode(F.sequence(_cell(F.col("b.min_y"), width), _cell(F.col("b.max_y"), width))))
    low_y, high_y = F.col("_cy") * width - slack, (F.col("_cy") + 1) * width + slack
    edges = _kept("by_column", lambda e: (F.greatest(e.y1, e.y2) >= low_y) & (F.least(e.y1, e.y2) <= high_y))
    return cells.select(key, "_level", "_cx", "_cy", edges.alias("edges")).filter(F.size("edges") > 0)


def _within_cell(cx: Column, cy: Column, size: Column, edges: Column) -> Column:
    """True for a cell within the area, false for one that an edge is near to, null for one outside.

    An edge is near when its box meets the cell with its slack. The test of a point that far from all edges
    is the same in the whole cell, so that of the centre stands for all.
    """
    bounds_of = {"x0": cx * size - size * 1e-6, "x1": (cx + 1) * size + size * 1e-6, "mx": (cx + 0.5) * size}
    bounds_of |= {"y0": cy * size - size * 1e-6, "y1": (cy + 1) * size + size * 1e-6, "my": (cy + 0.5) * size}
    box = F.struct(*[column.alias(name) for name, column in bounds_of.items()])
    exact = (F.abs(cx) < MAX_CELL) & (F.abs(cy) < MAX_CELL)

    def within(b: Column) -> Column:
        def near(e: Column) -> Column:
            beside = (F.greatest(e.x1, e.x2) < b.x0) | (F.least(e.x1, e.x2) > b.x1)
            return ~(beside | (F.greatest(e.y1, e.y2) < b.y0) | (F.least(e.y1, e.y2) > b.y1))

        passed = ~exact | F.exists(edges, lambda polygon: F.exists(polygon, near))
        return F.when(passed, False).when(strictly_within(b.mx, b.my, edges), True)

    # A list of one box, so that its bounds are computed once.
    return F.get(F.transform(F.array(box), within), F.lit(0))


def _size(level: Column, cell_size: float | None) -> Column:
    return F.pow(F.lit(float(STEP)), level) * (cell_size or 1.0)


def _exploded(cells: DataFrame, of_cell: Column, *kept: str) -> DataFrame:
    """Rows (kept, _level, _cx, _cy, _full, edges) of an array of such structs; full cells keep no edges."""
    placed = F.filter(of_cell, lambda c: c._full.isNotNull())
    cell = cells.select(*kept, F.explode(placed).alias("c"))
    fields = [F.col(f"c.{name}") for name in ("_level", "_cx", "_cy", "_full")]
    return cell.select(*kept, *fields, F.when(~F.col("c._full"), F.col("c.edges")).alias("edges"))


def _cell_struct(level: Column, cx: Column, cy: Column, size: Column, edges: Column) -> Column:
    full = _within_cell(cx, cy, size, edges)
    named = {"_level": level, "_cx": cx, "_cy": cy, "_full": full, "edges": edges}
    return F.struct(*[column.alias(name) for name, column in named.items()])


def _cutter(crowded: DataFrame, cell_size: float | None) -> Callable[[DataFrame], DataFrame]:
    """Cells as they are, but those among ``crowded`` that an edge passes cut into cells of the next finer grid."""
    cut = F.coalesce("_crowded", F.lit(False)) & ~F.col("_full")
    size, slack, steps = F.col("_size"), F.col("_size") * 1e-6, F.array(*[F.lit(i) for i in range(STEP)])

    def strip(number: Column, cell: str) -> Column:
        bounds_of = {cell: number, "low": number * size - slack, "high": (number + 1) * size + slack}
        return F.struct(*[column.alias(name) for name, column in bounds_of.items()])

    columns = F.transform(steps, lambda i: strip(F.col("_cx") * STEP + i, "_cx"))
    rows = F.transform(steps, lambda i: strip(F.col("_cy") * STEP + i, "_cy"))

    def column(c: Column) -> Column:
        return F.struct(c._cx.alias("_cx"), _kept(F.col("edges"), lambda e: F.greatest(e.x1, e.x2) >= c.low).alias("edges"))

    def cells_of(c: Column) -> Column:
        def row(r: Column) -> Column:
            edges = _kept(c.edges, lambda e: (F.greatest(e.y1, e.y2) >= r.low) & (F.least(e.y1, e.y2) <= r.high))
            return F.struct(r._cy.alias("_cy"), edges.alias("edges"))

        placed = F.transform(F.col("_rows"), row)
        return F.transform(placed, lambda r: _cell_struct(F.col("_level") - 1, c._cx, r._cy, size, r.edges))

    as_it_is = F.array(F.struct("_level", "_cx", "_cy", "_full", "edges"))
    finer = F.when(cut, F.flatten(F.transform(F.transform(columns, column), cells_of))).otherwise(as_it_is)
    crowded = crowded.withColumn("_crowded", F.lit(True))
    added = {"_size": _size(F.col("_level") - 1, cell_size)}

    def cutting(cells: DataFrame) -> DataFrame:
        marked = cells.join(crowded, _CELL, "left").withColumns(added).withColumn("_rows", F.when(cut, rows))
        return _exploded(marked, finer, "_area")

    return cutting


def _key(level: int, x: Column, y: Column, size: Column) -> Column:
    return F.struct(F.lit(level).alias("_level"), _cell(x, size).alias("_cx"), _cell(y, size).alias("_cy"))


def _matched(points: DataFrame, cells: DataFrame, x: str, y: str, how: str, broadcast: bool) -> DataFrame:
    """``points`` with the ``_area`` of each cell of their ``_key`` whose edges they lie within."""
    on, kept = ["_level", "_cx", "_cy"], [c for c in points.columns if c != "_key"]
    points = points.select("*", "_key.*")
    if broadcast:
        cells = F.broadcast(cells)
    else:
        points, cells = with_salts(points, cells, on)
        on = [*on, "_salt"]
    p, c = points.alias("p"), cells.alias("c")
    condition = reduce(lambda a, b: a & b, [F.col(f"p.{k}") == F.col(f"c.{k}") for k in on])
    inside = condition & strictly_within(F.col(f"p.{x}"), F.col(f"p.{y}"), F.col("c.edges"))
    return p.join(c, inside, how).select(*[F.col(f"p.{name}") for name in kept], "c._area")


_CELL = ["_level", "_cx", "_cy"]


class _Counting:
    """Places and areas met by cells, so that places can be counted without pairs.

    ``places`` are the distinct finite points with their number ``_n``. A cell is crowded when more than
    ``MAX_CELL_PLACES`` places lie in it; ``cells`` are those of the areas, cut until none that an outline
    passes is crowded (or its number nears ``MAX_CELL``).
    """

    def __init__(self, points: DataFrame, numbered: DataFrame, x: str, y: str, cell_size: float | None, limit: int):
        self.cell_size, self.limit = cell_size, limit
        finite = F.abs(F.col(x)) + F.abs(F.col(y)) < float("inf")  # null and NaN are not
        grouped = points.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), finite.alias("_finite"))
        every = pin(grouped.groupBy("_x", "_y").agg(F.count("*").alias("_n"), F.any_value("_finite").alias("_finite")), "places")
        self.places = every.filter("_finite").drop("_finite")
        self.nowhere = every.filter("not coalesce(_finite, false)").drop("_finite")
        levels = {r._level for r in _boxed(numbered, "_area", cell_size).select("_level").distinct().collect()}
        self.levels, parts, cuts, new = set(), [], set(), levels
        while new:
            counts = self.keyed(self.places, new).groupBy(*_CELL).agg(F.count("*").alias("_k"))
            finest = F.greatest(F.abs("_cx"), F.abs("_cy")) < MAX_CELL // STEP
            crowded = counts.filter((F.col("_k") > MAX_CELL_PLACES) & finest).drop("_k")
            part, counted = pin_measured(crowded, "crowded-cells", levels=F.collect_set("_level"))
            parts.append(part)
            cuts |= set(counted["levels"] or [])
            self.levels |= new
            new = {level - 1 for level in cuts} - self.levels
        self.crowded = reduce(DataFrame.unionByName, parts) if parts else None
        rounds = max((next(n for n in range(len(cuts) + 1) if level - n not in cuts) for level in levels), default=0)
        # Few bytes of geometry are much work: areas are dealt over all tasks, whatever files they lie in.
        base = area_cells(numbered.repartition(hot_slices(numbered), "_area"), "_area", cell_size)
        base = base.withColumn("_size", _size(F.col("_level"), cell_size))
        here = _cell_struct(F.col("_level"), F.col("_cx"), F.col("_cy"), F.col("_size"), F.col("edges"))
        self.cells = _exploded(base, F.array(here), "_area")
        cutting = _cutter(self.crowded, cell_size) if rounds else None
        for _ in range(rounds):
            self.cells = cutting(self.cells)

    def keyed(self, places: DataFrame, levels) -> DataFrame:
        keys = [
            _key(level, F.col("_x"), F.col("_y"), F.lit(float(STEP) ** level * (self.cell_size or 1.0))) for level in sorted(levels)
        ]
        return places.withColumn("_key", F.explode(F.array(*keys))).select("*", "_key.*").drop("_key")

    def tested(self, places: DataFrame) -> DataFrame:
        """The places by the cells in which they are tested."""
        single = self.keyed(places, self.levels).join(self.crowded, _CELL, "left_anti")
        return single.select(*_CELL, "_x", "_y", "_n", F.lit(False).alias("_full"))

    def meet(self, cells: DataFrame, places: DataFrame) -> DataFrame:
        """Cells of areas with the rows of ``places`` in them, tested where the cell is not full."""
        table, counted = pin_measured(places, "places-by-cell", n_rows=F.count(F.lit(1)))
        on = [*_CELL, "_full"]
        if counted["n_rows"] <= self.limit:
            table = F.broadcast(table)
        else:
            cells, table = with_salts(pin(cells, "cells-to-meet"), table, on)
            on = [*on, "_salt"]
        c, p = cells.alias("c"), table.alias("p")
        same = reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"p.{k}") for k in on])
        inside = F.col("c._full") | strictly_within(F.col("p._x"), F.col("p._y"), F.col("c.edges"))
        return c.join(p, same & inside).select("c._area", "p._x", "p._y", "p._n")

    def by_area(self) -> DataFrame:
        """Rows (_area, _n): the number of points in each area that has any."""
        whole = self.keyed(self.places, self.levels).groupBy(*_CELL).agg(F.sum("_n").alias("_n"))
        none = F.lit(None).cast("double")
        whole = whole.select(*_CELL, none.alias("_x"), none.alias("_y"), "_n", F.lit(True).alias("_full"))
        return self.meet(self.cells, whole.unionByName(self.tested(self.places))).groupBy("_area").agg(F.sum("_n").alias("_n"))

    def outside(self) -> DataFrame:
        """One row (_n): the number of points in no area. Only places that no full cell holds are tested."""
        if not self.levels:
            return self.nowhere.unionByName(self.places).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
        held = pin(self.cells.filter("_full").select(*_CELL).distinct(), "full-cells")
        within = self.keyed(self.places, self.levels).join(held, _CELL, "left_semi").select("_x", "_y").distinct()
        open_places = pin(self.places.join(within, ["_x", "_y"], "left_anti"), "open-places")
        found = self.meet(self.cells.filter("not _full"), self.tested(open_places)).select("_x", "_y").distinct()
        missed = open_places.join(found, ["_x", "_y"], "left_anti")
        return self.nowhere.unionByName(missed.select("_x", "_y", "_n")).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))


def within_join(
    points: DataFrame,
    areas: DataFrame,
    how: str = "left",
    x: str = "longitude",
    y: str = "latitude",
    cell_size: float | None = None,
    counted: str | None = None,
    max_broadcast_edges: int = MAX_BROADCAST_EDGES,
) -> DataFrame:
    """Points with the columns of every area they lie strictly within.

    ``areas`` has a ``geometry`` and any other columns; those whose geometry is not valid (open, short or
    with a coordinate that is not finite) hold no point. A point in two areas gives two rows; with
    ``how="left"`` a point in none gives one row of nulls. Cells carry a number and edges only, and the
    other columns of an area are joined behind them. Cells are pinned and measured: they are broadcast
    below ``max_broadcast_edges``, otherwise both sides are shuffled by cell with the crowded cells salted.
    There is one join for all levels; with ``how="left"`` points are then numbered in a table, and one more
    join by number attaches what was found.

    ``counted`` names a column for the number of rows that the join has for an area, and the result is one row
    for each area that holds points: its columns and that number, with ``how="left"`` also a row of nulls for
    the points in none. Pairs do not become rows then. The table that meets the cells holds places, and is
    broadcast up to ``max_broadcast_edges`` rows.
    """
    names = [c for c in areas.columns if c != "geometry"]
    numbered = pin(areas.filter(is_valid(F.col("geometry"))).withColumn("_area", F.monotonically_increasing_id()), "areas")
    if counted:
        counting = _Counting(points, numbered, x, y, cell_size, max_broadcast_edges)
        counts = counting.by_area() if counting.levels else points.sparkSession.createDataFrame([], "_area long, _n long")
        held = counts.join(numbered, "_area").select(*names, F.col("_n").alias(counted))
        if how == "inner":
            return held
        missed = counting.outside().filter("_n > 0")
        return held.unionByName(missed.select(*[F.lit(None).alias(name) for name in names], F.col("_n").alias(counted)))
    in_cell = F.aggregate("edges", F.lit(0), lambda acc, edges: acc + F.size(edges))
    cells, counted = pin_measured(
        area_cells(numbered, "_area", cell_size), "area-cells", n_edges=F.sum(in_cell), levels=F.collect_set("_level")
    )
    levels = sorted(counted["levels"] or [])  # powers of STEP
    keep, broadcast = how == "left", counted["n_edges"] <= max_broadcast_edges
    keys = F.array(*[_key(level, F.col(x), F.col(y), F.lit(cell_size or float(STEP) ** level)) for level in levels])
    if not levels:
        none = points.withColumn("_area", F.lit(None).cast("long"))
        joined = none if keep else none.limit(0)
    elif len(levels) == 1:
        # One key needs no explosion, and the join itself keeps points without an area.
        joined = _matched(points.withColumn("_key", F.get(keys, F.lit(0))), cells, x, y, how, broadcast)
    elif how == "inner":
        joined = _matched(points.withColumn("_key", F.explode(keys)), cells, x, y, how, broadcast)
    else:
        # Points are numbered and met by their place alone; one more join attaches what was found.
        source = pin(points.withColumn("_point", F.monotonically_increasing_id()), "points")
        placed = source.select("_point", x, y, F.explode(keys).alias("_key"))
        found = _matched(placed, cells, x, y, "inner", broadcast).select("_point", "_area")
        joined = source.join(found, "_point", "left")
    described = numbered.select("_area", *[F.col(name).alias(f"_of_{i}") for i, name in enumerate(names)])
    return joined.join(described, "_area", how).select(
        *[joined[name] for name in points.columns], *[F.col(f"_of_{i}").alias(name) for i, name in enumerate(names)]
    )


def count_unmatched(points: DataFrame, areas: DataFrame, name: str, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """One row: how many points lie in no area. Points are not joined with the areas that hold them."""
    numbered = pin(
        areas.filter(is_valid(F.col("geometry"))).select("geometry", F.monotonically_increasing_id().alias("_area")), "areas"
    )
    return _Counting(points, numbered, x, y, None, MAX_BROADCAST_EDGES).outside().withColumnRenamed("_n", name)
