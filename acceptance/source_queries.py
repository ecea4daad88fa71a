"""Sources, sinks, the live feed and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import Inputs, half_up
from dwellrank.functions.scalars import station_or_null, utc_instant
from dwellrank.operators.asof import asof_join
from dwellrank.operators.joins import station_areas
from dwellrank.operators.skew import join_lookup
from dwellrank.plans.punctuality import area_punctuality, city_counters, city_snapshots, delays_with_area
from dwellrank.plans.punctuality import feed_profile as profile
from dwellrank import schemas
from dwellrank.schemas import STOP_LOOKUP
from dwellrank.session import scratch_path
from dwellrank.sources import sinks
from dwellrank.sources.documents import (
    earliest_events,
    flatten_events,
    merge_conditions,
    read_air_quality,
    read_event_search,
    read_weather,
)
from dwellrank.sources.feed import read_feed, sample_updates, stop_updates
from dwellrank.sources.files import read_csv, read_multiline_csv
from dwellrank.plans.versions import area_punctuality_as_of, next_versions
from dwellrank.streaming.punctuality import (
    append_stream,
    read_area_snapshots,
    read_city_snapshots,
    run_counters,
    windowed_punctuality,
)
from dwellrank.streaming.series import run_series
from dwellrank.streaming.windows import read_late, read_windows, run_windows


def land_json(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.json(path)
    return path


def feed_time():
    """The feed's own time stands in for the run time, so results can be compared."""
    return F.timestamp_seconds(F.col("feed_timestamp"))


def comparable(df: DataFrame) -> DataFrame:
    """Instants as epoch seconds."""
    return df.withColumn("snapshot_time", F.unix_seconds("snapshot_time"))


@query("select neighbourhood, count(*) as stops from v_lookup group by neighbourhood")
def src_csv_roundtrip(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "lookup-csv")
    sinks.replace_csv(t.lookup, path)
    return read_csv(t.spark, path, STOP_LOOKUP).groupBy("neighbourhood").agg(F.count("*").alias("stops"))


@query("select doc_id, length(text) as n_chars, length(text) - length(replace(text, chr(10), '')) as line_breaks from documents")
def src_csv_gz_multiline(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "documents-csv-gz")
    sinks.replace_csv(t.table("documents").select("doc_id", "text"), path, compression="gzip", rows_per_file=1_000)
    documents = read_multiline_csv(t.spark, path, "doc_id bigint, text string")
    n_chars = F.length("text").cast("long")
    breaks = n_chars - F.length(F.replace("text", F.lit("\n"), F.lit(""))).cast("long")
    return documents.select("doc_id", n_chars.alias("n_chars"), breaks.alias("line_breaks"))


@query("select name, day as date, venue, latitude, longitude, category from v_flat_events")
def json_flatten_events(t: Inputs) -> DataFrame:
    path = land_json(t.event_documents, "event-search")
    events = flatten_events(read_event_search(t.spark, path))
    return events.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("""
    select name, day as date, venue from v_flat_events order by day, name limit 200""")
def earliest_events_page(t: Inputs) -> DataFrame:
    path = land_json(t.event_documents, "event-search")
    page = earliest_events(flatten_events(read_event_search(t.spark, path)))
    return page.select("name", F.date_format("date", "yyyy-MM-dd").alias("date"), "venue")


@query("""
    select location, observed, temperature_c, humidity_pct, wind_kmh, rain_mm, weather_code, european_aqi, pm2_5, pm10, ozone
    from v_conditions""")
def json_merge_two_docs(t: Inputs) -> DataFrame:
    weather = read_weather(t.spark, land_json(t.weather, "weather"))
    air = read_air_quality(t.spark, land_json(t.air_quality, "air-quality"))
    return merge_conditions(weather, air).drop("snapshot_time")


_AS_OF = """
    select w.location, strftime(w.at, '%Y-%m-%dT%H:%M') as observed, w.value as temperature_c, w.value * 4 as rain_mm,
           case when FRESH then a.value end as european_aqi, case when FRESH then a.value * 4 end as ozone
    from (from v_timed where of_weather) w
    asof left join (from v_timed where not of_weather) a on w.location = a.location and w.at >= a.at"""


def _conditions(t: Inputs, tolerance: Column | None = None) -> DataFrame:
    weather = read_weather(t.spark, land_json(t.timed_weather, "weather"))
    air = read_air_quality(t.spark, land_json(t.timed_air_quality, "air-quality"))
    return merge_conditions(weather, air, tolerance=tolerance).select(
        "location", "observed", "temperature_c", "rain_mm", "european_aqi", "ozone"
    )


@query(_AS_OF.replace("FRESH", "true"))
def conditions_as_of(t: Inputs) -> DataFrame:
    """Two services that report at different times, a third of all observations at one place."""
    return _conditions(t)


@query(_AS_OF.replace("FRESH", "w.at - a.at <= interval 90 minute"))
def conditions_as_of_tolerance(t: Inputs) -> DataFrame:
    return _conditions(t, F.expr("interval 90 minutes"))


@query("""
    select p.event_id, c.event_id as click_id
    from (from events where event_type = 'purchase') p
    asof left join (select user_id % 3 as k, ts, max(event_id) as event_id from events where event_type = 'click' group by all) c
    on p.user_id % 3 = c.k and p.ts >= c.ts""")
def asof_last_click(t: Inputs) -> DataFrame:
    """Every purchase with the last click before it, in three groups of users."""
    events = t.table("events").select("event_id", (F.col("user_id") % 3).alias("k"), "ts", "event_type")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "k", "ts")
    clicks = events.filter("event_type = 'click'").select("k", "ts", F.col("event_id").alias("click_id"))
    return asof_join(purchases, clicks, ["k"], "ts").select("event_id", "click_id")


@query("""
    select feed_timestamp, stop_id, delay from v_delays where stop_id is not null and delay is not null""")
def nested_feed_explode(t: Inputs) -> DataFrame:
    return stop_updates(t.feed)


@query("""
    select feed_timestamp, count(*) + count(*) filter (with_vehicle) as entities, count(*) as trip_updates,
           count(*) filter (with_vehicle) as vehicles,
           any_value(delays) as delays, any_value(on_time) as on_time, any_value(late) as late, any_value(early) as early,
           any_value(max_delay_min) as max_delay_min, any_value(min_delay_min) as min_delay_min
    from v_trips join (
        select feed_timestamp, count(delay) as delays, count(*) filter (abs(delay) <= 60) as on_time,
               count(*) filter (delay > 60) as late, count(*) filter (delay < -60) as early,
               cast(floor(max(delay) / 60) as bigint) as max_delay_min, cast(floor(min(delay) / 60) as bigint) as min_delay_min
        from v_delays group by feed_timestamp) using (feed_timestamp)
    group by feed_timestamp""")
def feed_profile(t: Inputs) -> DataFrame:
    return profile(t.feed)


@query("""
    select substr('trip-' || lpad(cast(user_id as varchar), 8, '0') || '-' || snapshot || '-' || chunk, 1, 25) as trip,
           cast(stop_updates as int) as stop_updates, coalesce(stop_id, '(no stop_id)') as stop_id,
           coalesce(cast(delay as varchar), '(no delay)') as delay
    from v_delays join (select feed_timestamp, chunk, user_id, stop_updates from v_trips) using (feed_timestamp, chunk, user_id)
    order by trip, stop_id, delay, stop_updates limit 15""")
def feed_sample(t: Inputs) -> DataFrame:
    return sample_updates(t.feed)


SNAPSHOT = """
    select snapshot_time, feed_timestamp, active_trips, total_stop_updates, on_time, late, early, pct_on_time, avg_delay_seconds
    from v_snapshots"""


@query(SNAPSHOT)
def punctuality_snapshot(t: Inputs) -> DataFrame:
    return comparable(city_snapshots(city_counters(t.feed), feed_time()))


_BY_GROUP = f"""
    select neighbourhood, count(*) as updates, {half_up('100 * count(*) filter (abs(delay) <= 60) / count(*)', 1)} as pct_on_time,
           {half_up('sum(delay) / count(*)', 1)} as avg_delay_seconds
    from v_area_delays where delay > -7200 and delay < 7200"""


@query(_BY_GROUP + " group by neighbourhood")
def punctuality_by_group(t: Inputs) -> DataFrame:
    return area_punctuality(t.delays, t.lookup, keys=()).drop("snapshot_time")


@query("select event_id, station, neighbourhood, delay from v_area_delays")
def join_lookup_broadcast(t: Inputs) -> DataFrame:
    return delays_with_area(t.delays, t.lookup).select("event_id", "station", "neighbourhood", "delay")


@query("""
    select neighbourhood, count(*) as stops, 1 as copies from v_lookup group by neighbourhood""")
def sink_overwrite(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "overwritten")
    sinks.replace(t.lookup, path)
    sinks.replace(t.lookup, path)
    stored = t.spark.read.schema(STOP_LOOKUP).parquet(path)
    per_stop = stored.groupBy("neighbourhood", "stop_id").agg(F.count("*").alias("copies"))
    return per_stop.groupBy("neighbourhood").agg(
        F.count("*").alias("stops"), F.max("copies").cast("int").alias("copies")
    )


@query("""
    select neighbourhood, count(*) as stops, 2 as copies from v_lookup group by neighbourhood""")
def sink_append_series(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "appended")
    sinks.append(t.lookup, path, STOP_LOOKUP)
    sinks.append(t.lookup, path, STOP_LOOKUP)
    stored = t.spark.read.schema(STOP_LOOKUP).parquet(path)
    per_stop = stored.groupBy("neighbourhood", "stop_id").agg(F.count("*").alias("copies"))
    return per_stop.groupBy("neighbourhood").agg(
        F.count("*").alias("stops"), F.min("copies").cast("int").alias("copies")
    )


@query("select count(*) as listings, count(price) as priced, max(price) as max_price from v_listings")
def observed_metrics(t: Inputs) -> DataFrame:
    found = sinks.replace_with_metrics(
        t.listings,
        scratch_path(t.spark, "observed"),
        {"listings": F.count(F.lit(1)), "priced": F.count("price"), "max_price": F.max("price")},
    )
    return t.spark.createDataFrame(
        [(found["listings"], found["priced"], found["max_price"])], "listings bigint, priced bigint, max_price double"
    )


@query(SNAPSHOT)
def stream_snapshot(t: Inputs) -> DataFrame:
    landed = land_json(t.feed, "feed")
    city = scratch_path(t.spark, "city-counters")
    run_counters(t.spark, landed, scratch_path(t.spark, "stream-state"), city)
    return comparable(read_city_snapshots(t.spark, city, feed_time()))


@query("""
    select strftime(day, '%Y-%m-%d') as day, count(*) as updates, """ + f"""
           {half_up('100 * count(*) filter (abs(delay) <= 60) / count(*)', 1)} as pct_on_time,
           {half_up('sum(delay) / count(*)', 1)} as avg_delay_seconds
    from (select date_trunc('day', ts) as day, delay from v_delays where delay > -7200 and delay < 7200)
    where day + interval 1 day <= (select max(ts) - interval 1 hour from v_delays)
    group by day""")
def stream_tumbling(t: Inputs) -> DataFrame:
    raw = t.table("events").schema
    stream = t.spark.readStream.schema(raw).parquet(f"{t.folder}/events.parque[t]")
    updates = stream.select(
        utc_instant(F.col("ts")).alias("at"),
        F.expr("case when event_id % 23 = 0 then null else cast(floor(value * 100) as int) - 1000 end").alias("delay"),
    )
    path = scratch_path(t.spark, "windows")
    append_stream(windowed_punctuality(updates, "at"), path, scratch_path(t.spark, "stream-state"))
    windows = t.spark.read.schema(
        "window_start timestamp, updates bigint, pct_on_time double, avg_delay_seconds double"
    ).parquet(path)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window_start") / 86400).cast("int"))
    return windows.select(
        F.date_format(day, "yyyy-MM-dd").alias("day"), "updates", "pct_on_time", "avg_delay_seconds"
    )


@query(_BY_GROUP + " group by neighbourhood")
def stream_static_join(t: Inputs) -> DataFrame:
    landed = land_json(t.feed, "feed")
    city, area = scratch_path(t.spark, "city-counters"), scratch_path(t.spark, "area-counters")
    run_counters(t.spark, landed, scratch_path(t.spark, "stream-state"), city, area, station_areas(t.lookup))
    return read_area_snapshots(t.spark, area, keys=()).drop("snapshot_time")


BY_FEED_AND_AREA = (
    _BY_GROUP.replace("select neighbourhood", "select feed_timestamp, neighbourhood")
    + " group by feed_timestamp, neighbourhood"
)


@query(BY_FEED_AND_AREA)
def punctuality_by_feed_and_area(t: Inputs) -> DataFrame:
    feed = read_feed(t.spark, land_json(t.feed, "feed"))
    return area_punctuality(stop_updates(feed), t.lookup).drop("snapshot_time")


@query(SNAPSHOT)
def stream_replay(t: Inputs) -> DataFrame:
    """The stream run again from the start, as when its state is lost: every landed file still counts once."""
    landed, city = land_json(t.feed, "feed"), scratch_path(t.spark, "city-counters")
    for _ in range(2):
        run_counters(t.spark, landed, scratch_path(t.spark, "stream-state"), city, max_files=3)
    return comparable(read_city_snapshots(t.spark, city, feed_time()))


@query("select event_id, station, neighbourhood, delay from v_area_delays")
def join_lookup_split(t: Inputs) -> DataFrame:
    """The lookup join with a lookup too large to broadcast: stations with many updates are split off."""
    keyed = t.delays.withColumn("station", station_or_null(F.col("stop_id")))
    joined = join_lookup(keyed, station_areas(t.lookup), "station", max_broadcast_rows=0)
    return joined.select("event_id", "station", "neighbourhood", "delay")


@query("select doc_id, md5(text) as digest from documents")
def src_csv_line_breaks(t: Inputs) -> DataFrame:
    """All texts through quoted, gzipped files: line breaks, quotes and blanks come back as they were."""
    path = scratch_path(t.spark, "texts-csv-gz")
    sinks.replace_csv(t.table("documents").select("doc_id", "text"), path, compression="gzip", rows_per_file=1_000)
    return read_multiline_csv(t.spark, path, "doc_id bigint, text string").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("select * from v_lookup")
def src_csv_reordered_headers(t: Inputs) -> DataFrame:
    """Columns in another order and among others are found by their names."""
    path = scratch_path(t.spark, "reordered-csv")
    sinks.replace_csv(t.lookup.select(F.lit("x").alias("extra"), "neighbourhood", "stop_id"), path)
    return read_csv(t.spark, path, STOP_LOOKUP)


@query(SNAPSHOT)
def stream_state_snapshot(t: Inputs) -> DataFrame:
    """Every feed lands in two parts, each read by a run of its own; the second one takes up the state of the first."""
    landed, series, state = (scratch_path(t.spark, name) for name in ("feed-parts", "state-series", "stream-state"))
    odd = F.size("entity") % 2 == 1
    for part in (odd, ~odd):
        t.feed.filter(part).write.mode("append").json(landed)
        run_series(t.spark, landed, state, series, feed_time(), lateness="60 days")
    return comparable(sinks.read_series(t.spark, series, schemas.PUNCTUALITY))


# The days of the feed land in three parts; updates of every fifth user come one part late.
_DAY = "(feed_timestamp // 86400 - (select min(feed_timestamp) // 86400 from v_delays))"
_LANDED = f"select *, {_DAY} as day, least({_DAY} // 11 + case when user_id % 5 = 0 then 1 else 0 end, 2) as landing from v_delays"
_MARKED = f"""
    select d.*, day + 1 <= coalesce((select max(e.day) - 1e0 / 24 from ({_LANDED}) e where e.landing < d.landing), -1) as late
    from ({_LANDED}) d"""


def _run_parts(t: Inputs) -> str:
    first = t.delays.agg(F.min("feed_timestamp")).first()[0] // 86400
    day = F.floor(F.col("feed_timestamp") / 86400) - first
    landing = F.least(F.floor(day / 11) + F.when(F.col("user_id") % 5 == 0, 1).otherwise(0), F.lit(2))
    update = F.struct("stop_id", F.struct("delay").alias("arrival"))
    trip = F.struct(F.col("user_id").cast("string").alias("trip_id"), F.lit("r").alias("route_id"))
    entity = F.struct(F.struct(trip.alias("trip"), F.array(update).alias("stop_time_update")).alias("trip_update"))
    messages = t.delays.select(
        landing.alias("landing"), F.struct(F.col("feed_timestamp").alias("timestamp")).alias("header"), F.array(entity).alias("entity")
    )
    landed, state, out = (scratch_path(t.spark, name) for name in ("late-feed", "stream-state", "windows"))
    for part in range(3):
        messages.filter(F.col("landing") == part).drop("landing").write.mode("append").json(landed)
        run_windows(t.spark, landed, state, out)
    return out


@query(f"""
    select strftime(make_timestamp(feed_timestamp * 1000000), '%Y-%m-%d') as day, count(*) as updates,
           {half_up('100 * count(*) filter (abs(delay) <= 60) / count(*)', 1)} as pct_on_time
    from ({_MARKED}) where not late and stop_id is not null and delay > -7200 and delay < 7200 group by feed_timestamp""")
def stream_windows_by_header(t: Inputs) -> DataFrame:
    """Windows by the time of the message header, without the updates that came behind the watermark."""
    return read_windows(t.spark, _run_parts(t)).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "updates", "pct_on_time")


@query(f"""
    select strftime(make_timestamp(feed_timestamp * 1000000), '%Y-%m-%d') as day, stop_id, count(*) as updates
    from ({_MARKED}) where late and stop_id is not null and delay is not null group by all""")
def stream_late_rows(t: Inputs) -> DataFrame:
    """The updates behind the watermark, kept aside and counted."""
    late = read_late(t.spark, _run_parts(t))
    return late.groupBy(F.date_format("event_time", "yyyy-MM-dd").alias("day"), "stop_id").agg(F.count("*").alias("updates"))


_MOVED = r"""
    select d.feed_timestamp, case when moves and feed_timestamp >= 1705276800 then other else s.neighbourhood end as neighbourhood, delay
    from (select *, nullif(regexp_extract(stop_id, '^(de:\d+:\d+)', 1), '') as station from v_delays) d
    join (select s.station, s.neighbourhood, n.n_name as other, cast(split_part(s.station, ':', 3) as bigint) % 3 = 0 as moves
          from v_station_areas s
          join nation m on m.n_name = s.neighbourhood join nation n on n.n_nationkey = (m.n_nationkey + 1) % 25) s using (station)"""


@query(f"""
    select neighbourhood, count(*) as updates, {half_up('100 * count(*) filter (abs(delay) <= 60) / count(*)', 1)} as pct_on_time,
           {half_up('sum(delay) / count(*)', 1)} as avg_delay_seconds
    from ({_MOVED}) where delay > -7200 and delay < 7200 group by neighbourhood""")
def lookup_as_of_version(t: Inputs) -> DataFrame:
    """Every third station moves to another area on 15 January: its updates count in each area for their time."""
    nations = t.table("nation").select("n_nationkey", F.col("n_name").alias("neighbourhood"))
    following = nations.select(((F.col("n_nationkey") + 24) % 25).alias("n_nationkey"), F.col("neighbourhood").alias("other")).join(nations, "n_nationkey")
    before = station_areas(t.lookup)
    moves = F.get(F.split("station", ":"), F.lit(2)).cast("bigint") % 3 == 0
    after = before.join(following, "neighbourhood").select("station", F.when(moves, F.col("other")).otherwise(F.col("neighbourhood")).alias("neighbourhood"))
    first = next_versions(None, before, F.timestamp_seconds(F.lit(0)))
    versions = next_versions(first, after, F.timestamp_seconds(F.lit(1705276800)))
    return area_punctuality_as_of(t.delays, versions, keys=()).drop("snapshot_time")
