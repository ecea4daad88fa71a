"""Polygon functions on nested arrays.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (the first is the outline, the others
are holes), a ring ``array<vertex>`` and a vertex ``[longitude, latitude]``. All functions are
built-in array functions, so geometry never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellrank.constants import EARTH_RADIUS_KM

GEOMETRY_TYPE = "array<array<array<array<double>>>>"


def _lon(vertex: Column) -> Column:
    return F.get(vertex, F.lit(0))


def _lat(vertex: Column) -> Column:
    return F.get(vertex, F.lit(1))


def ring_edges(ring: Column) -> Column:
    """Consecutive vertices of a ring as ``struct<x1, y1, x2, y2>``."""
    n_edges = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, 1, n_edges),
        F.slice(ring, 2, n_edges),
        lambda a, b: F.struct(
            _lon(a).alias("x1"), _lat(a).alias("y1"), _lon(b).alias("x2"), _lat(b).alias("y2")
        ),
    )


def polygon_edges(geometry: Column) -> Column:
    """Per polygon, the edges of all its rings."""
    return F.transform(geometry, lambda polygon: F.flatten(F.transform(polygon, ring_edges)))


def bounds(geometry: Column) -> Column:
    """Bounding box as ``struct<min_x, min_y, max_x, max_y>``."""
    vertices = F.flatten(F.flatten(geometry))
    lons, lats = F.transform(vertices, _lon), F.transform(vertices, _lat)
    return F.struct(
        F.array_min(lons).alias("min_x"),
        F.array_min(lats).alias("min_y"),
        F.array_max(lons).alias("max_x"),
        F.array_max(lats).alias("max_y"),
    )


def _touches(edge: Column, x: Column, y: Column) -> Column:
    cross = (edge.x2 - edge.x1) * (y - edge.y1) - (edge.y2 - edge.y1) * (x - edge.x1)
    return (
        (cross == 0)
        & x.between(F.least(edge.x1, edge.x2), F.greatest(edge.x1, edge.x2))
        & y.between(F.least(edge.y1, edge.y2), F.greatest(edge.y1, edge.y2))
    )


def _crosses(edge: Column, x: Column, y: Column) -> Column:
    """True when a ray from the point towards larger x crosses the edge."""
    at_x = F.try_divide((edge.x2 - edge.x1) * (y - edge.y1), edge.y2 - edge.y1) + edge.x1
    return ((edge.y1 > y) != (edge.y2 > y)) & (x < at_x)


def strictly_within(x: Column, y: Column, edges_by_polygon: Column) -> Column:
    """True when the point is inside some polygon (even-odd rule) and not on its boundary."""

    def inside(edges: Column) -> Column:
        crossings = F.size(F.filter(edges, lambda edge: _crosses(edge, x, y)))
        return (crossings % 2 == 1) & ~F.exists(edges, lambda edge: _touches(edge, x, y))

    return F.exists(edges_by_polygon, inside)


def is_valid(geometry: Column) -> Column:
    """At least one ring, and every ring closed, of four or more finite vertices."""

    def finite(vertex: Column) -> Column:
        return F.coalesce(
            (F.size(vertex) >= 2)
            & F.forall(vertex, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))),
            F.lit(False),
        )

    def closed(ring: Column) -> Column:
        return F.coalesce(
            (F.size(ring) >= 4)
            & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1))
            & F.forall(ring, finite),
            F.lit(False),
        )

    polygons_ok = F.forall(geometry, lambda polygon: (F.size(polygon) > 0) & F.forall(polygon, closed))
    return F.coalesce((F.size(geometry) > 0) & polygons_ok, F.lit(False))


def _number_text(value: Column) -> Column:
    """Shortest plain decimal text: no exponent, no trailing zeros, no trailing point."""
    plain = F.format_string("%.20f", value)
    return F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))


def to_wkt(geometry: Column, geometry_type: Column) -> Column:
    """Well-known text; ``geometry_type`` is ``Polygon`` or ``MultiPolygon``."""

    def vertex_text(vertex: Column) -> Column:
        return F.concat_ws(" ", _number_text(_lon(vertex)), _number_text(_lat(vertex)))

    def bracketed(items: Column, text) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(items, text), ", "), F.lit(")"))

    def polygon_text(polygon: Column) -> Column:
        return bracketed(polygon, lambda ring: bracketed(ring, vertex_text))

    return F.when(
        geometry_type == "Polygon",
        F.concat(F.lit("POLYGON "), polygon_text(F.get(geometry, F.lit(0)))),
    ).otherwise(F.concat(F.lit("MULTIPOLYGON "), bracketed(geometry, polygon_text)))


def area_km2(geometry: Column) -> Column:
    """Area on a sphere: outlines minus holes."""

    def ring_area(ring: Column) -> Column:
        terms = F.transform(
            ring_edges(ring),
            lambda e: F.radians(e.x2 - e.x1) * (2 + F.sin(F.radians(e.y1)) + F.sin(F.radians(e.y2))),
        )
        total = F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term)
        return F.abs(total) * (EARTH_RADIUS_KM * EARTH_RADIUS_KM / 2)

    def polygon_area(polygon: Column) -> Column:
        signed = F.transform(
            polygon, lambda ring, i: F.when(i == 0, ring_area(ring)).otherwise(-ring_area(ring))
        )
        return F.aggregate(signed, F.lit(0.0), lambda acc, part: acc + part)

    return F.aggregate(
        F.transform(geometry, polygon_area), F.lit(0.0), lambda acc, part: acc + part
    )


_NUMBER = r"[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?"


def wkt_type(text: Column) -> Column:
    """``Polygon`` or ``MultiPolygon``, by the first word; null for anything else."""
    tag = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    return F.when(tag == "POLYGON", "Polygon").when(tag == "MULTIPOLYGON", "MultiPolygon")


def from_wkt(text: Column) -> Column:
    """The geometry of well-known text, or null where any part of it does not parse.

    Words in either case and blanks anywhere between the parts are allowed. Vertices have two numbers. The
    text is split at its brackets from the outside in: polygons, rings, vertices, numbers. A bracket that is
    missing, doubled or out of place stays behind in some number, which is none then.
    """
    body = F.regexp_replace(F.regexp_replace(text, r"^\s*[A-Za-z]+", ""), r"\s*([(),])\s*", "$1")
    body = F.regexp_replace(F.trim(body), r"\s+", " ")
    nested = F.when(wkt_type(text) == "Polygon", F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    inner = F.substring(nested, F.lit(4), F.length(nested) - 6)
    framed = nested.startswith("(((") & nested.endswith(")))") & (F.length(nested) > 6)

    def vertex(part: Column) -> Column:
        return F.when(part.rlike(f"^{_NUMBER} {_NUMBER}$"), F.transform(F.split(part, " "), lambda v: v.try_cast("double")))

    def ring(part: Column) -> Column:
        return F.transform(F.split(part, ","), vertex)

    def whole(geometry: Column) -> Column:
        return F.forall(geometry, lambda p: F.forall(p, lambda r: F.forall(r, lambda v: v.isNotNull())))

    polygons = F.transform(
        F.split(inner, r"\)\),\(\("), lambda polygon: F.transform(F.split(polygon, r"\),\("), ring)
    )
    # A list of one geometry, so that its text is taken apart once.
    read = F.filter(F.array(polygons), whole)
    return F.when(wkt_type(text).isNotNull() & framed, F.get(read, F.lit(0)))
