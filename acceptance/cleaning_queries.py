"""Projections, filters, scalar functions, deduplication and plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import Inputs, half_up
from dwellrank.functions import scalars as fn
from dwellrank.operators.joins import area_stations, station_areas
from dwellrank.operators.medians import interpolated_median
from dwellrank.plans.connectivity import city_departures, departures_per_stop_hour, station_counts
from dwellrank.plans.events import with_category
from dwellrank.plans.listings import area_prices, listing_summary


@query("""
    select count(*) as n, count(*) filter (try_cast(replace(replace(price, '$', ''), ',', '') as double) is null) as bad_prices,
           (select count(*) from v_stop_times where try_cast(split_part(departure_time, ':', 1) as int) is null) as bad_hours
    from v_raw""")
def cast_lenient(t: Inputs) -> DataFrame:
    hours = t.stop_times.agg(
        F.count_if(fn.clock_part(F.col("departure_time"), 0).isNull()).alias("n")
    ).scalar()
    return t.raw_listings.agg(
        F.count("*").alias("n"), F.count_if(fn.money(F.col("price")).isNull()).alias("bad_prices")
    ).withColumn("bad_hours", hours)


@query("""
    select substr(stop_id, 1, 9) as stop_prefix, count(*) as n from v_stop_times
    where departure_time is not null and departure_time <> '' group by 1""")
def filter_nonempty(t: Inputs) -> DataFrame:
    return (
        t.stop_times.filter(fn.has_text(F.col("departure_time")))
        .groupBy(F.substring("stop_id", 1, 9).alias("stop_prefix"))
        .agg(F.count("*").alias("n"))
    )


@query("select substr(stop_id, 1, 9) as stop_prefix, count(*) as n from v_city_times group by 1")
def filter_prefix(t: Inputs) -> DataFrame:
    return city_departures(t.stop_times).groupBy(F.substring("stop_id", 1, 9).alias("stop_prefix")).agg(F.count("*").alias("n"))


@query("select l_partkey, count(*) as n from lineitem group by l_partkey having count(*) >= 30")
def having_min_count(t: Inputs) -> DataFrame:
    return t.table("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).filter(F.col("n") >= 30)


@query("select event_id, delay from v_delays where delay is not null and stop_id is not null")
def dropna_subset(t: Inputs) -> DataFrame:
    return t.delays.dropna(subset=["delay", "stop_id"]).select("event_id", "delay")


@query("select event_id, delay from v_delays where delay > -7200 and delay < 7200")
def filter_open_range(t: Inputs) -> DataFrame:
    return t.delays.filter(fn.usable_delay(F.col("delay"))).select("event_id", "delay")


@query("select id, accommodates, price from v_listings")
def null_outliers(t: Inputs) -> DataFrame:
    return t.listings.select("id", "accommodates", "price")


@query("select coalesce(category, 'Other') as category, count(*) as n from v_points group by 1")
def fill_default(t: Inputs) -> DataFrame:
    return with_category(t.points).groupBy("category").agg(F.count("*").alias("n"))


@query("""
    select cast(split_part(departure_time, ':', 1) as int) % 24 as hour, count(*) as n, min(shown) as first_shown
    from (select s.departure_time, strftime(e.ts, '%H:%M:%S') as shown from v_stop_times s join events e using (event_id)
          where s.departure_time is not null and s.departure_time <> '') group by 1""")
def hour_wrap(t: Inputs) -> DataFrame:
    clock = t.table("events").select("event_id", F.date_format("ts", "HH:mm:ss").alias("shown"))
    return (
        t.stop_times.filter(fn.has_text(F.col("departure_time")))
        .join(clock, "event_id")
        .groupBy(fn.service_hour(F.col("departure_time")).alias("hour"))
        .agg(F.count("*").alias("n"), F.min("shown").alias("first_shown"))
    )


@query(r"""
    select stop_id, regexp_extract(stop_id, '(de:\d+:\d+)', 1) as anywhere,
           nullif(regexp_extract(stop_id, '^(de:\d+:\d+)', 1), '') as at_start, count(*) as n
    from (select case when event_id % 31 = 0 then 'x' || stop_id when event_id % 37 = 0 then 'zz' else stop_id end as stop_id
          from v_stop_times) group by all""")
def regex_station(t: Inputs) -> DataFrame:
    damaged = F.expr(
        "case when event_id % 31 = 0 then concat('x', stop_id) when event_id % 37 = 0 then 'zz' else stop_id end"
    )
    stop = F.col("stop_id")
    return (
        t.stop_times.select(damaged.alias("stop_id"))
        .groupBy("stop_id")
        .agg(F.count("*").alias("n"))
        .select("stop_id", fn.station_or_blank(stop).alias("anywhere"), fn.station_or_null(stop).alias("at_start"), "n")
    )


@query("select price as price_text, try_cast(replace(replace(price, '$', ''), ',', '') as double) as price, count(*) as n from v_raw group by all")
def parse_money(t: Inputs) -> DataFrame:
    return (
        t.raw_listings.groupBy("price")
        .agg(F.count("*").alias("n"))
        .select(F.col("price").alias("price_text"), fn.money(F.col("price")).alias("price"), "n")
    )


@query(f"select event_id, {half_up('value / 8', 2)} as rounded from events")
def round_parity(t: Inputs) -> DataFrame:
    return t.table("events").select("event_id", F.round(F.col("value") / 8, 2).alias("rounded"))


@query(f"""
    select l_orderkey, l_linenumber, {half_up('l_discount * l_extendedprice', 1)} as one_digit,
           {half_up('l_discount * l_extendedprice', 2)} as two_digits from lineitem""")
def round_parity_product(t: Inputs) -> DataFrame:
    product = F.col("l_discount") * F.col("l_extendedprice")
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.round(product, 1).alias("one_digit"), F.round(product, 2).alias("two_digits")
    )


@query("""
    select event_id, cast(floor(epoch(ts)) as bigint) as seconds,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as back from events""")
def epoch_seconds(t: Inputs) -> DataFrame:
    seconds = fn.epoch_seconds(F.col("ts"))
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    back = F.timestamp_add("SECOND", seconds.cast("int"), origin)
    return t.table("events").select(
        "event_id", seconds.alias("seconds"), F.date_format(back, "yyyy-MM-dd HH:mm:ss").alias("back")
    )


@query("select distinct neighbourhood, station_id from v_area_stations")
def distinct_rows(t: Inputs) -> DataFrame:
    return area_stations(t.lookup)


@query("select station, neighbourhood from v_station_areas")
def dedup_first(t: Inputs) -> DataFrame:
    return station_areas(t.lookup)


@query("select stop_id, hour, count(*) as departures from v_city_times group by all")
def agg_count_two_keys(t: Inputs) -> DataFrame:
    return departures_per_stop_hour(t.stop_times)


@query("""
    select neighbourhood, cast(sum(departures) as bigint) as departures
    from (select stop_id, hour, count(*) as departures from v_city_times group by all) join v_lookup using (stop_id)
    group by neighbourhood""")
def agg_rollup_sum(t: Inputs) -> DataFrame:
    counts = departures_per_stop_hour(t.stop_times)
    return counts.join(t.lookup, "stop_id").groupBy("neighbourhood").agg(F.sum("departures").alias("departures"))


@query("select neighbourhood, count(*) as num_stations from v_area_stations group by neighbourhood")
def agg_distinct_per_group(t: Inputs) -> DataFrame:
    return station_counts(t.lookup)


@query(f"""
    select neighbourhood_cleansed as neighbourhood, count(*) as num_listings,
           {half_up('quantile_disc(price, 0.5)', 2)} as median_price
    from v_listings where price is not null group by 1""")
def agg_median_by_group(t: Inputs) -> DataFrame:
    return area_prices(t.listings, min_listings=0)


@query(f"select {half_up('quantile_cont(price, 0.5)', 2)} as median_price from v_listings")
def agg_median_exact(t: Inputs) -> DataFrame:
    return interpolated_median(t.listings, "price", "median_price")


@query("""
    select count(*) as listings, count(price) as priced_listings,
           count(distinct neighbourhood_cleansed) as neighbourhoods from v_listings""")
def profile_summary(t: Inputs) -> DataFrame:
    return listing_summary(t.listings)


@query("select event_id, event_type from events order by ts, event_id limit 200")
def topk_asc(t: Inputs) -> DataFrame:
    return t.table("events").orderBy("ts", "event_id").limit(200).select("event_id", "event_type")
