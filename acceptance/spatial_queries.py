"""Points in areas, area geometry and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import VIEWS, Inputs, half_up
from dwellrank.functions.geometry import area_km2, is_valid, to_wkt
from dwellrank.operators.spatial import count_unmatched, within_join
from dwellrank.plans.events import busiest, events_by_category, events_scores
from dwellrank.plans.geometry import area_geometry_from_text, stop_lookup
from dwellrank.session import scratch_path
from dwellrank.sources.files import read_geojson

_VERTEX = "regexp_replace(v[1]::varchar, '\\.0$', '') || ' ' || regexp_replace(v[2]::varchar, '\\.0$', '')"
_RING = f"'(' || array_to_string(list_transform(r, lambda v: {_VERTEX}), ', ') || ')'"
_POLYGON = f"'(' || array_to_string(list_transform(p, lambda r: {_RING}), ', ') || ')'"
_RADIUS = "6371.0088::double"
_EDGE = (
    "radians(r[i + 1][1] - r[i][1]) * (2 + sin(radians(r[i][2])) + sin(radians(r[i + 1][2])))"
)

VIEWS["v_parcel_wkt"] = f"""
    select c_custkey, neighbourhood, shape,
           case when geometry_type = 'Polygon' then 'POLYGON ' || list_transform(geometry, lambda p: {_POLYGON})[1]
                else 'MULTIPOLYGON (' || array_to_string(list_transform(geometry, lambda p: {_POLYGON}), ', ') || ')'
           end as geometry_wkt
    from v_parcels"""
VIEWS["v_parcel_rings"] = """
    select c_custkey, neighbourhood, shape, polygon_no, unnest(polygon) as r, generate_subscripts(polygon, 1) as ring_no
    from (select c_custkey, neighbourhood, shape, unnest(geometry) as polygon, generate_subscripts(geometry, 1) as polygon_no
          from v_parcels)"""


def land_geojson(features: DataFrame, key: str, per_file: int = 500) -> str:
    """Write features as GeoJSON collections of at most ``per_file`` features, one per line."""
    spark = features.sparkSession
    coordinates = F.when(
        F.col("geometry_type") == "Polygon", F.to_json(F.get("geometry", F.lit(0)))
    ).otherwise(F.to_json("geometry"))
    feature = F.concat(
        F.lit('{"type": "Feature", "properties": {"neighbourhood": "'),
        "neighbourhood",
        F.lit('"}, "geometry": {"type": "'),
        "geometry_type",
        F.lit('", "coordinates": '),
        coordinates,
        F.lit("}}"),
    )
    collections = (
        features.groupBy(F.floor(F.col(key) / per_file).alias("page"))
        .agg(F.array_join(F.collect_list(feature), ", ").alias("features"))
        .select(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "features", F.lit("]}")))
    )
    path = scratch_path(spark, "geojson")
    collections.write.text(path)
    return path


@query("""
    select neighbourhood, polygon_no::int as polygon_no, ring_no::int as ring_no, len(r)::int as vertices from v_parcel_rings""")
def src_geojson_rings(t: Inputs) -> DataFrame:
    areas = read_geojson(t.spark, land_geojson(t.parcels, "c_custkey"), multiline=False)
    rings = areas.select("neighbourhood", F.posexplode("geometry").alias("p", "polygon")).select(
        "neighbourhood", "p", F.posexplode("polygon").alias("r", "ring")
    )
    return rings.select(
        "neighbourhood", (F.col("p") + 1).alias("polygon_no"), (F.col("r") + 1).alias("ring_no"), F.size("ring").alias("vertices")
    )


@query("select vec_id, neighbourhood from v_points left join v_hits using (vec_id)")
def spatial_within(t: Inputs) -> DataFrame:
    return within_join(t.points, t.districts, "left").select("vec_id", "neighbourhood")


@query("select vec_id, neighbourhood from v_hits")
def spatial_within_shuffled(t: Inputs) -> DataFrame:
    """The same join with the cells too many to broadcast."""
    return within_join(t.points, t.districts, "inner", max_broadcast_edges=0).select("vec_id", "neighbourhood")


_PLACES = "(select event_id, 8 + (user_id % 97) * 1e-1 as x, 45 + (event_id % 89) * 1e-1 as y from events)"
_SQUARES = """(select c_custkey, c_custkey % 311 as area, 8 + (c_custkey % 101) * 9e-2 as x0, 45 + (c_custkey // 7 % 103) * 8e-2 as y0,
                      case c_custkey % 3 when 0 then 3e-2 when 1 then 4e-1 else 3e0 end as side from customer)"""
_INSIDE = f"""from {_PLACES} p, {_SQUARES} s where x > x0 and x < x0 + side and y > y0 and y < y0 + side"""


def _squares(t: Inputs) -> DataFrame:
    """A square per customer, of three very different sizes."""
    x0 = 8 + (F.col("c_custkey") % 101) * 9e-2
    y0 = 45 + (F.floor(F.col("c_custkey") / 7) % 103) * 8e-2
    side = F.when(F.col("c_custkey") % 3 == 0, 3e-2).when(F.col("c_custkey") % 3 == 1, 4e-1).otherwise(3e0)
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in corners])
    boxed = t.table("customer").select("c_custkey", x0.alias("x0"), y0.alias("y0"), side.alias("side"))
    return boxed.withColumns({"x1": F.col("x0") + F.col("side"), "y1": F.col("y0") + F.col("side")}).select(
        (F.col("c_custkey") % 311).alias("area"), F.array(F.array(ring)).alias("geometry")
    )


def _places(t: Inputs) -> DataFrame:
    return t.table("events").select(
        "event_id",
        (8 + (F.col("user_id") % 97) * 1e-1).alias("longitude"),
        (45 + (F.col("event_id") % 89) * 1e-1).alias("latitude"),
    )


@query(f"select area, count(*) as points {_INSIDE} group by area")
def spatial_within_many_areas(t: Inputs) -> DataFrame:
    """All events in squares of three sizes, one for each customer."""
    counts = within_join(_places(t), _squares(t), "inner", counted="n")
    return counts.groupBy("area").agg(F.sum("n").alias("points"))


@query(f"select area, count(*) as points {_INSIDE} group by area")
def spatial_within_bad_polygon_all(t: Inputs) -> DataFrame:
    """All squares with one area added that reaches to infinity and one that is open."""
    ring = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in ((0.0, 0.0), (float("inf"), 0.0), (1.0, 1.0), (0.0, 0.0))])
    bad = t.spark.range(2).select((-F.col("id")).alias("area"), F.array(F.array(F.when(F.col("id") == 0, ring).otherwise(F.slice(ring, 1, 2)))).alias("geometry"))
    counts = within_join(_places(t), _squares(t).unionByName(bad), "inner", counted="n")
    return counts.groupBy("area").agg(F.sum("n").alias("points"))


_BLOCKS = """(select s_suppkey as area, 11 + (s_suppkey % 7) * 15e-2 as x0, 48 + (s_suppkey % 5) * 21e-2 as y0,
                     case s_suppkey % 3 when 0 then 3e-1 when 1 then 1e0 else 3e0 end as side from supplier)"""


@query(f"""
    select area, cast(sum(n) as bigint) as points
    from (select 12 + k * 1e-2 as x, 49 + k * 1e-2 as y, n
          from (select event_id % 3 as k, count(*) as n from events group by event_id % 3)) p, {_BLOCKS} s
    where x > x0 and x < x0 + side and y > y0 and y < y0 + side group by area""")
def spatial_within_hot_point_all(t: Inputs) -> DataFrame:
    """All events on three places, counted on the shuffled path in a square for every supplier."""
    key = F.col("s_suppkey")
    side = F.when(key % 3 == 0, 3e-1).when(key % 3 == 1, 1.0).otherwise(3.0)
    boxed = t.table("supplier").select(
        key.alias("area"), (11 + (key % 7) * 15e-2).alias("x0"), (48 + (key % 5) * 21e-2).alias("y0"), side.alias("side")
    )
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("side"), F.col("y0") + F.col("side")
    ring = F.array(*[F.array(a, b) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    third = (F.col("event_id") % 3) * 1e-2
    spots = t.table("events").select((12 + third).alias("longitude"), (49 + third).alias("latitude"))
    areas = boxed.select("area", F.array(F.array(ring)).alias("geometry"))
    counts = within_join(spots, areas, "inner", counted="n", max_broadcast_edges=0)
    return counts.groupBy("area").agg(F.sum("n").alias("points"))


@query(f"""
    select coalesce(s.area, -1) as area, count(*) as events
    from {_PLACES} p left join {_SQUARES} s on x > x0 and x < x0 + side and y > y0 and y < y0 + side group by 1""")
def spatial_within_events_left(t: Inputs) -> DataFrame:
    """Every event in all squares it lies in, on three levels at once; those in none are kept."""
    counts = within_join(_places(t), _squares(t), "left", counted="n", max_broadcast_edges=0)
    return counts.groupBy(F.coalesce("area", F.lit(-1)).alias("area")).agg(F.sum("n").alias("events"))


@query(f"select count(*) as outside from {_PLACES} p where not exists (select 1 from {_SQUARES} s where x > x0 and x < x0 + side and y > y0 and y < y0 + side)")
def anti_unmatched_events(t: Inputs) -> DataFrame:
    return count_unmatched(_places(t), _squares(t), "outside")


@query("select count(*) as outside from v_points where vec_id not in (select vec_id from v_hits)")
def anti_unmatched(t: Inputs) -> DataFrame:
    return count_unmatched(t.points, t.districts, "outside")


@query("select 'stop-' || vec_id as stop_id, neighbourhood from v_hits")
def stop_area_lookup(t: Inputs) -> DataFrame:
    stops = t.points.select(
        F.concat(F.lit("stop-"), "vec_id").alias("stop_id"),
        F.col("latitude").cast("string").alias("stop_lat"),
        F.col("longitude").cast("string").alias("stop_lon"),
    )
    return stop_lookup(stops, t.districts)


@query("select neighbourhood, event_count, events_score from v_events_score")
def events_score(t: Inputs) -> DataFrame:
    return events_scores(t.points, t.districts)


@query("""
    select neighbourhood, category, event_count,
           cast(sum(event_count) over (partition by neighbourhood) as bigint) as total_events from v_category_counts""")
def agg_size_by_category(t: Inputs) -> DataFrame:
    return events_by_category(t.points, t.districts)


@query("select neighbourhood, category, event_count from v_category_counts order by event_count desc, neighbourhood, category limit 10")
def topk(t: Inputs) -> DataFrame:
    return busiest(events_by_category(t.points, t.districts)).select("neighbourhood", "category", "event_count")


@query("select neighbourhood, geometry_wkt from v_parcel_wkt")
def geo_wkt(t: Inputs) -> DataFrame:
    return t.parcels.select("neighbourhood", to_wkt(F.col("geometry"), F.col("geometry_type")).alias("geometry_wkt"))


@query("select neighbourhood, shape < 4 as valid from v_parcels")
def geo_valid(t: Inputs) -> DataFrame:
    return t.parcels.select("neighbourhood", is_valid(F.col("geometry")).alias("valid"))


# Texts beside those of the parcels, by customer: a bow tie, a hole outside, a hole across the outline, a spike,
# a missing bracket, a word for a number, a third number, and one written in another style.
_SPOILED = {
    1: "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))",
    2: "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (5 5, 6 5, 6 6, 5 6, 5 5))",
    3: "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))",
    4: "POLYGON ((0 0, 4 0, 2 0, 4 4, 0 4, 0 0))",
    5: "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0))",
    6: "POLYGON ((0 0, 4 0, 4 four, 0 4, 0 0))",
    7: "POLYGON ((0 0 1, 4 0 1, 4 4 1, 0 0 1))",
    8: "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0)), ((2 2, 3 2, 3 3, 2 2)))",
    9: " multipolygon( ((0 0,-1e1 .5,1. +4,0 0)) ) ",
}
_SPOILED_SQL = " ".join(f"when {k} then '{v}'" for k, v in _SPOILED.items())


@query(f"""
    select neighbourhood, coalesce(vertices, 0)::int as vertices, geometry_wkt from (
        select neighbourhood, case c_custkey % 13 {_SPOILED_SQL} else geometry_wkt end as geometry_wkt,
               case when c_custkey % 13 = 9 then 4 when c_custkey % 13 between 1 and 8 or shape >= 4 then 0 else n end as vertices
        from v_parcel_wkt join (select c_custkey, sum(len(r)) as n from v_parcel_rings group by 1) using (c_custkey))""")
def geo_parse_text(t: Inputs) -> DataFrame:
    """Geometry read from the text of all parcels, nine in thirteen of them spoiled or in another style."""
    case = F.col("c_custkey") % 13
    text = to_wkt(F.col("geometry"), F.col("geometry_type"))
    for k, spoiled in _SPOILED.items():
        text = F.when(case == k, spoiled).otherwise(text)
    table = area_geometry_from_text(t.parcels.select("neighbourhood", text.alias("geometry_wkt")))
    vertices = F.aggregate("geometry", F.lit(0), lambda n, polygon: F.aggregate(polygon, n, lambda m, ring: m + F.size(ring)))
    return table.select("neighbourhood", F.coalesce(vertices, F.lit(0)).alias("vertices"), "geometry_wkt")


@query(f"""
    select neighbourhood, {half_up('sum(case when ring_no = 1 then area else -area end)', 4)} as area_km2
    from (select neighbourhood, polygon_no, ring_no,
                 abs(list_sum(list_transform(generate_series(1, len(r) - 1), lambda i: {_EDGE}))) * {_RADIUS} * {_RADIUS} / 2 as area
          from v_parcel_rings where shape < 4)
    group by neighbourhood""")
def geo_area(t: Inputs) -> DataFrame:
    valid = t.parcels.filter(is_valid(F.col("geometry")))
    return valid.select("neighbourhood", F.round(area_km2(F.col("geometry")), 4).alias("area_km2"))
