"""Declared schemas (as DDL) of every input and append table; nothing is inferred."""

from __future__ import annotations

STOP_TIMES = "trip_id string, stop_id string, departure_time string"
STOPS = "stop_id string, stop_lat string, stop_lon string"
STOP_LOOKUP = "stop_id string, neighbourhood string"
AREA_TEXT = "neighbourhood string, geometry_wkt string"
AREA_SIZES = "neighbourhood string, area_km2 string"

_LISTING_HEAD = (
    "id long, latitude double, longitude double, neighbourhood_cleansed string, "
    "neighbourhood_group_cleansed string, room_type string, property_type string, "
    "accommodates int, bedrooms double, "
)
_LISTING_TAIL = (
    ", review_scores_rating double, review_scores_location double, number_of_reviews int, "
    "estimated_occupancy_l365d double, estimated_revenue_l365d double"
)
RAW_LISTINGS = _LISTING_HEAD + "price string" + _LISTING_TAIL
CLEAN_LISTINGS = _LISTING_HEAD + "price double" + _LISTING_TAIL

EVENTS = (
    "name string, date date, venue string, latitude double, longitude double, category string"
)

EVENT_SEARCH = (
    "_embedded struct<events: array<struct<"
    "name: string, "
    "dates: struct<start: struct<localDate: string>>, "
    "_embedded: struct<venues: array<struct<"
    "name: string, location: struct<latitude: string, longitude: string>>>>, "
    "classifications: array<struct<segment: struct<name: string>>>>>>"
)

WEATHER = (
    "location string, current struct<time: string, temperature_2m: double, "
    "relative_humidity_2m: double, wind_speed_10m: double, rain: double, weather_code: int>"
)
AIR_QUALITY = (
    "location string, current struct<time: string, european_aqi: double, pm2_5: double, "
    "pm10: double, ozone: double>"
)

FEED = (
    "header struct<timestamp: bigint>, entity array<struct<"
    "trip_update: struct<trip: struct<trip_id: string, route_id: string>, "
    "stop_time_update: array<struct<stop_id: string, arrival: struct<delay: int>>>>, "
    "vehicle: struct<trip: struct<trip_id: string>>>>"
)

FEATURE_COLLECTION = (
    "features array<struct<properties: struct<neighbourhood: string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)

PUNCTUALITY = (
    "snapshot_time timestamp, feed_timestamp bigint, active_trips bigint, "
    "total_stop_updates bigint, on_time bigint, late bigint, early bigint, "
    "pct_on_time double, avg_delay_seconds double"
)
AREA_PUNCTUALITY = (
    "neighbourhood string, updates bigint, pct_on_time double, avg_delay_seconds double, "
    "snapshot_time timestamp"
)
CONDITIONS = (
    "snapshot_time timestamp, temperature_c double, humidity_pct double, wind_kmh double, "
    "rain_mm double, weather_code int, european_aqi double, pm2_5 double, pm10 double, ozone double"
)

# What a stored series holds beside its published columns, so that a run again can be told from news.
AREA_PUNCTUALITY_KEYED = AREA_PUNCTUALITY + ", feed_timestamp bigint"
CONDITIONS_KEYED = CONDITIONS + ", location string, observed string"
