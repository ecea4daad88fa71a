"""Joins, scores, ranks, checks, the mart and the dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import VIEWS, Inputs, exact_mean, exact_sum, half_up, minmax
from dwellrank.functions.scalars import epoch_seconds
from dwellrank.functions.scalars import exact_sum as exact_sum_column
from dwellrank.operators.checks import failing_accepted_values, failing_not_null, failing_unique
from dwellrank.operators.joins import attach_group_total
from dwellrank.operators.quantiles import exact_quantiles
from dwellrank.operators.ranking import with_ntile, with_percent_rank, with_rank, with_row_number
from dwellrank.operators.scaling import score_table, with_delta_from_mean
from dwellrank.operators.summaries import DISTINCT_ERROR, RANK_ERROR, merged_summaries, read_summaries, summaries
from dwellrank.plans import mart as marts
from dwellrank.plans.connectivity import (
    connectivity_scores,
    daily_departures,
    departures_by_hour as hourly_departures,
    departures_with_location,
    transit_measures,
)
from dwellrank.plans.events import events_scores
from dwellrank.plans.geometry import area_geometry
from dwellrank.plans.listings import room_type_breakdown as room_types, value_scores
from dwellrank.plans.punctuality import city_counters
from dwellrank.session import pin, run_together, scratch_path
from dwellrank.sources import sinks
from dwellrank.sources.files import staged_scores

VIEWS.update(
    {
        "v_suppliers": f"select l_suppkey, {exact_sum('l_extendedprice')} as revenue from lineitem group by l_suppkey",
        "v_supplier_scores": f"select *, {half_up(minmax('revenue'), 1)} as score from v_suppliers",
    }
)


def suppliers(t: Inputs) -> DataFrame:
    return t.table("lineitem").groupBy("l_suppkey").agg(exact_sum_column(F.col("l_extendedprice")).alias("revenue"))


def supplier_scores(t: Inputs) -> DataFrame:
    return pin(score_table(suppliers(t), {"revenue": "score"}), "supplier-scores")


def mart_inputs(t: Inputs) -> list[DataFrame]:
    return run_together(
        t.spark,
        lambda: value_scores(t.listings),
        lambda: connectivity_scores(t.stop_times, t.lookup, t.areas),
        lambda: events_scores(t.points, t.districts),
    )


def mart(t: Inputs) -> DataFrame:
    return marts.stay_score_mart(*mart_inputs(t))


@query("""
    select stop_id, hour, departures, lat, lon
    from (select stop_id, hour, count(*) as departures from v_city_times group by all)
    left join (select distinct stop_id, 52 + cast(split_part(stop_id, ':', 3) as bigint) % 100 * 1e-2 as lat,
                      13 + cast(split_part(stop_id, ':', 3) as bigint) % 10 * 1e-2 as lon from v_stop_times
               where split_part(stop_id, ':', 4) <> '1') using (stop_id)""")
def join_left(t: Inputs) -> DataFrame:
    known = t.stops.filter(~F.col("stop_id").endswith(":1"))
    return departures_with_location(t.stop_times, known)


@query("select neighbourhood, daily_departures from v_daily")
def join_inner_broadcast(t: Inputs) -> DataFrame:
    return daily_departures(t.stop_times, t.lookup)


@query("select neighbourhood, daily_departures, num_stations, area_km2 from v_measures")
def join_inner_chain(t: Inputs) -> DataFrame:
    return transit_measures(t.stop_times, t.lookup, t.areas).select(
        "neighbourhood", "daily_departures", "num_stations", "area_km2"
    )


@query("""
    select doc_id, source, quality, coalesce(n_docs, 0) as n_docs, coalesce(toxic, 0) as toxic
    from documents left join labels using (doc_id)
    left join (select source, count(*) as n_docs from documents where lang = 'en' group by source) using (source)
    where quality is not null""")
def join_left_chain_using(t: Inputs) -> DataFrame:
    docs = t.table("documents").select("doc_id", "source", "lang")
    per_source = docs.filter(F.col("lang") == "en").groupBy("source").agg(F.count("*").alias("n_docs"))
    return (
        docs.join(t.table("labels"), "doc_id", "left")
        .join(per_source, "source", "left")
        .filter(F.col("quality").isNotNull())
        .select(
            "doc_id",
            "source",
            "quality",
            F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )


@query("""
    select event_type, user_id, count(*) as n, cast(sum(count(*)) over (partition by event_type) as bigint) as n_type
    from events group by event_type, user_id""")
def group_total_attach(t: Inputs) -> DataFrame:
    counts = t.table("events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return attach_group_total(counts, "event_type", "n", "n_type")


@query(f"""
    select neighbourhood, {half_up('daily_departures / num_stations', 6)} as dep_per_station,
           {half_up('daily_departures / nullif(case when n_nationkey = 7 then 0e0 else area_km2 end, 0)', 6)} as dep_per_km2
    from v_measures join (select neighbourhood, n_nationkey from v_areas) using (neighbourhood)""")
def ratio_metrics(t: Inputs) -> DataFrame:
    return transit_measures(t.stop_times, t.lookup, t.areas_with_zero).select(
        "neighbourhood",
        F.round("density.per_station", 6).alias("dep_per_station"),
        F.round("density.per_km2", 6).alias("dep_per_km2"),
    )


@query("select l_suppkey, revenue, score from v_supplier_scores")
def score_minmax(t: Inputs) -> DataFrame:
    return score_table(suppliers(t), {"revenue": "score"})


@query("select neighbourhood, num_listings, median_price, value_score from v_value")
def score_minmax_inverted(t: Inputs) -> DataFrame:
    return value_scores(t.listings)


@query("""
    select neighbourhood, dep_per_station_score, dep_per_km2_score, connectivity_score
    from v_density_scores join (select neighbourhood, connectivity_score from v_connectivity) using (neighbourhood)""")
def score_composite(t: Inputs) -> DataFrame:
    return connectivity_scores(t.stop_times, t.lookup, t.areas, detail=True).select(
        "neighbourhood",
        F.col("density_score.per_station").alias("dep_per_station_score"),
        F.col("density_score.per_km2").alias("dep_per_km2_score"),
        "connectivity_score",
    )


@query(f"""
    select neighbourhood, {half_up('(station_score + density_score) / 2', 1)} as connectivity_score
    from (select neighbourhood, {half_up(minmax('dep_per_station'), 1)} as station_score,
                 {half_up(minmax('density'), 1)} as density_score
          from (select *, ln(1 + dep_per_km2) as density from v_measures))""")
def score_log1p(t: Inputs) -> DataFrame:
    return connectivity_scores(t.stop_times, t.lookup, t.areas, density_transform="log1p").select(
        "neighbourhood", "connectivity_score"
    )


@query("select neighbourhood, stay_score from v_scored")
def score_blend(t: Inputs) -> DataFrame:
    return marts.scored_areas(*mart_inputs(t)).select("neighbourhood", "stay_score")


@query(f"""
    select l_suppkey, percentile, case when percentile >= 0.6 and score_percentile >= 0.6 then 'Hidden Gem'
             when score_percentile >= 0.6 and percentile < 0.4 then 'Premium / Central'
             when percentile >= 0.6 and score_percentile < 0.4 then 'Budget / Remote' else 'Balanced' end as label
    from (select l_suppkey, {half_up('percent_rank() over (order by s_acctbal)', 2)} as percentile,
                 {half_up('percent_rank() over (order by score)', 2)} as score_percentile
          from v_supplier_scores join supplier on l_suppkey = s_suppkey)""")
def archetype_case(t: Inputs) -> DataFrame:
    balances = t.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    both = pin(supplier_scores(t).join(balances, "l_suppkey"), "supplier-balances")
    ranked = with_percent_rank(with_percent_rank(both, "s_acctbal", "percentile"), "score", "score_percentile")
    return ranked.select(
        "l_suppkey", "percentile", marts.area_type(F.col("percentile"), F.col("score_percentile")).alias("label")
    )


@query("select l_suppkey, score, rank() over (order by score desc) as score_rank from v_supplier_scores")
def win_rank(t: Inputs) -> DataFrame:
    return with_rank(supplier_scores(t).select("l_suppkey", "score"), "score", "score_rank")


@query(f"""
    select l_suppkey, score, {half_up('percent_rank() over (order by score)', 2)} as score_percentile
    from v_supplier_scores""")
def win_percent_rank(t: Inputs) -> DataFrame:
    return with_percent_rank(supplier_scores(t).select("l_suppkey", "score"), "score", "score_percentile")


@query("""
    select l_suppkey, score, cast(ntile(4) over (order by score desc, l_suppkey) as int) as quartile,
           cast(ntile(7) over (order by score desc, l_suppkey) as int) as seventh
    from v_supplier_scores""")
def win_ntile(t: Inputs) -> DataFrame:
    order = [F.col("score").desc(), F.col("l_suppkey").asc()]
    scores = supplier_scores(t).select("l_suppkey", "score")
    return with_ntile(with_ntile(scores, 4, order, "quartile"), 7, order, "seventh")


@query(f"""
    select l_suppkey, {half_up(f"score - (select {exact_mean('score')} from v_supplier_scores)", 1)} as score_vs_avg
    from v_supplier_scores""")
def win_delta_from_mean(t: Inputs) -> DataFrame:
    return with_delta_from_mean(supplier_scores(t), {"score": "score_vs_avg"}).select("l_suppkey", "score_vs_avg")


@query("""
    select l_orderkey, l_linenumber, l_extendedprice, rank() over (order by l_extendedprice desc) as price_rank
    from lineitem""")
def win_rank_distributed(t: Inputs) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return with_rank(lines, "l_extendedprice", "price_rank")


@query("""
    select l_linenumber, l_quantity, quantity_rank, count(*) as n
    from (select l_linenumber, l_quantity, rank() over (order by l_quantity desc) as quantity_rank from lineitem)
    group by all""")
def win_rank_hot_values(t: Inputs) -> DataFrame:
    lines = t.table("lineitem").select("l_linenumber", "l_quantity")
    return with_rank(lines, "l_quantity", "quantity_rank").groupBy("l_linenumber", "l_quantity", "quantity_rank").agg(
        F.count("*").alias("n")
    )


@query("""
    select event_id, row_number() over (order by event_type, event_id) as place from events""")
def win_row_number_distributed(t: Inputs) -> DataFrame:
    events = t.table("events").select("event_id", "event_type")
    return with_row_number(events, [F.col("event_type").asc(), F.col("event_id").asc()], "place").select("event_id", "place")


@query("select l_orderkey, count(*) as n_rows from lineitem group by l_orderkey having count(*) > 1")
def check_unique(t: Inputs) -> DataFrame:
    return failing_unique(t.table("lineitem"), "l_orderkey")


@query("select event_id, stop_id from v_delays where delay is null")
def check_not_null(t: Inputs) -> DataFrame:
    return failing_not_null(t.delays, "delay").select("event_id", "stop_id")


@query("""
    select event_type, count(*) as n_rows from events
    where event_type not in ('click', 'error', 'purchase', 'view') group by event_type""")
def check_accepted_values(t: Inputs) -> DataFrame:
    return failing_accepted_values(t.table("events"), "event_type", ["click", "error", "purchase", "view"])


@query("""
    select 'not_null' as "check", 'neighbourhood' as "column", count(*) filter (neighbourhood is null) as failures from v_mart
    union all select 'not_null', 'stay_score', count(*) filter (stay_score is null) from v_mart
    union all select 'not_null', 'neighbourhood_type', count(*) filter (neighbourhood_type is null) from v_mart
    union all select 'accepted_values', 'neighbourhood_type', count(*) filter (neighbourhood_type not in
        ('Hidden Gem', 'Premium / Central', 'Budget / Remote', 'Balanced')) from v_mart
    union all select 'unique', 'neighbourhood', count(*) from (select neighbourhood from v_mart group by 1 having count(*) > 1)""")
def check_mart(t: Inputs) -> DataFrame:
    return marts.mart_checks(pin(mart(t), "mart"))


@query("select neighbourhood, hour, count(*) as departures from v_city_times join v_lookup using (stop_id) group by all")
def departures_by_hour(t: Inputs) -> DataFrame:
    return hourly_departures(t.stop_times, t.lookup)


@query(f"""
    select count(*) as active_listings, {half_up('sum(cast(round(price * 100) as bigint)) / count(price) / 100', 2)} as avg_nightly_price,
           (select {half_up('sum(on_time) * 100 / sum(total_stop_updates)', 1)} from v_snapshots) as pct_on_time,
           (select count(*) from v_city_events where day >= '2024-01-15') as upcoming_events
    from v_listings""")
def kpi_tiles(t: Inputs) -> DataFrame:
    events = t.city_events.select(F.to_date("day").alias("date"))
    return marts.headline_figures(t.spark, t.listings, city_counters(t.feed), events, F.lit("2024-01-15").cast("date"))


@query(f"""
    select room_type, count(*) as num_listings, {half_up('sum(cast(round(price * 100) as bigint)) / count(*) / 100', 2)} as avg_price,
           {half_up('quantile_cont(price, 0.5)', 2)} as median_price
    from v_listings where price is not null group by room_type""")
def room_type_breakdown(t: Inputs) -> DataFrame:
    return room_types(t.listings)


MART = """
    select neighbourhood, value_score, connectivity_score, events_score, stay_score, overall_rank, value_percentile,
           connectivity_percentile, stay_quartile, connectivity_vs_avg, value_vs_avg, neighbourhood_type
    from v_mart"""


@query(MART)
def mart_stay_score(t: Inputs) -> DataFrame:
    return mart(t)


@query("select neighbourhood_type, count(*) as areas from v_mart group by 1")
def archetype_counts(t: Inputs) -> DataFrame:
    return marts.area_type_counts(mart(t))


@query("""
    select neighbourhood, overall_rank, stay_score, value_score, connectivity_score, median_price, num_listings, neighbourhood_type
    from v_mart join (select neighbourhood, median_price, num_listings from v_value) using (neighbourhood)""")
def ranked_detail(t: Inputs) -> DataFrame:
    value, connectivity, events = mart_inputs(t)
    return marts.ranked_detail(marts.stay_score_mart(value, connectivity, events), value)


@query("""
    select neighbourhood, num_listings, median_price, len(geometry) as polygons
    from v_value join v_districts using (neighbourhood)""")
def price_map(t: Inputs) -> DataFrame:
    mapped = marts.price_map(value_scores(t.listings), area_geometry(t.districts))
    polygons = F.regexp_count("geometry_wkt", F.lit(r"\(\(")).cast("long")
    return mapped.select("neighbourhood", "num_listings", "median_price", polygons.alias("polygons"))


@query("select neighbourhood, value_score, connectivity_score from v_value join v_connectivity using (neighbourhood)")
def staged_views(t: Inputs) -> DataFrame:
    text = lambda df, score: df.select("neighbourhood", F.col(score).cast("string").alias(score))
    text(value_scores(t.listings), "value_score").createOrReplaceTempView("value_score_table")
    text(connectivity_scores(t.stop_times, t.lookup, t.areas), "connectivity_score").createOrReplaceTempView(
        "connectivity_score_table"
    )
    staged_scores(t.spark, "value_score_table", "value_score").createOrReplaceTempView("staged_value")
    staged_scores(t.spark, "connectivity_score_table", "connectivity_score").createOrReplaceTempView("staged_connectivity")
    return t.spark.sql(
        "select neighbourhood, value_score, connectivity_score from staged_value join staged_connectivity using (neighbourhood)"
    )


@query("""
    select region, part, size, cast(sum(size) over (partition by region) as bigint) as total
    from (select case when c_custkey % 5 > 0 then c_nationkey end as region, c_mktsegment as part, count(*) as size
          from customer group by all)""")
def group_total_null_key(t: Inputs) -> DataFrame:
    """Totals of groups of which one has no key."""
    region = F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey")).alias("region")
    sizes = t.table("customer").groupBy(region, F.col("c_mktsegment").alias("part")).agg(F.count("*").alias("size"))
    return attach_group_total(sizes, "region", "size", "total")


@query("""
    select event_id, rank() over (order by 9007199254740992 + event_id // 2) as place from events""")
def win_rank_big_integers(t: Inputs) -> DataFrame:
    """Ranks of integers that are one and the same as doubles."""
    big = F.lit(2**53) + F.floor(F.col("event_id") / 2)
    return with_rank(t.table("events").select("event_id", big.alias("v")), "v", "place", descending=False).drop("v")


@query("""
    select l_suppkey, count(l_extendedprice) as n, quantile_disc(l_extendedprice, 0.5) as median, quantile_disc(l_extendedprice, 0.9) as high
    from lineitem group by l_suppkey""")
def quantiles_by_supplier(t: Inputs) -> DataFrame:
    """Exact quantiles of raw prices for every supplier."""
    return exact_quantiles(t.table("lineitem"), "l_suppkey", "l_extendedprice", [0.5, 0.9], ["median", "high"])


@query("""
    select l_returnflag, count(l_extendedprice) as n, quantile_disc(l_extendedprice, 0.25) as lower, quantile_disc(l_extendedprice, 0.5) as median
    from lineitem group by l_returnflag""")
def quantiles_of_large_groups(t: Inputs) -> DataFrame:
    """The same for three groups that hold all rows."""
    return exact_quantiles(t.table("lineitem"), "l_returnflag", "l_extendedprice", [0.25, 0.5], ["lower", "median"])


@query("select count(value) as n, median(value) as median from events")
def median_of_doubles(t: Inputs) -> DataFrame:
    """The median of all raw values, the mean of the two in the middle."""
    return exact_quantiles(t.table("events"), None, "value", [0.5], ["median"], interpolated=True)


@query("""
    select week, count(*) as n_rows, count(distinct event_id) as events, true as distinct_in_bound, true as median_in_bound
    from (select event_id, cast(epoch(ts) as bigint) // 604800 as week from events) group by week""")
def summaries_merged_by_week(t: Inputs) -> DataFrame:
    """Daily sketches, committed as a series, merged by week, and held against the exact figures of all rows."""
    events = t.table("events").select(
        "event_id", "value", F.floor(epoch_seconds(F.col("ts")) / 86400).cast("bigint").alias("day")
    )
    path = scratch_path(t.spark, "summaries")
    schema = "day bigint, n_rows bigint, event_id_distinct binary, value_quantiles binary"
    daily = summaries(events, ["day"], ["event_id"], ["value"])
    for _ in range(2):
        sinks.commit_series(daily, path, schema, ["day"], F.floor(F.col("day") / 30))
    stored = sinks.read_series(t.spark, path, schema).withColumn("week", F.floor(F.col("day") / 7))
    found = pin(read_summaries(merged_summaries(stored.drop("day"), ["week"]), [0.5]), "weeks")
    exact = (
        events.withColumn("week", F.floor(F.col("day") / 7))
        .join(F.broadcast(found.select("week", F.get("value_quantiles", F.lit(0)).alias("estimate"))), "week")
        .groupBy("week")
        .agg(F.count_distinct("event_id").alias("events"), F.count_if(F.col("value") <= F.col("estimate")).alias("up_to"))
    )
    close = F.abs(F.col("event_id_distinct") - F.col("events")) <= DISTINCT_ERROR * F.col("events")
    # The median's rank may be off by its bound, and by the copies of one value.
    near = F.abs(F.col("up_to") / F.col("n_rows") - 0.5) <= RANK_ERROR + 0.005
    return found.join(exact, "week").select(
        F.col("week").cast("bigint").alias("week"), "n_rows", "events", close.alias("distinct_in_bound"), near.alias("median_in_bound")
    )
