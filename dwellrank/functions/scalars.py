"""Scalar column functions. Text that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellrank.constants import MAX_PRICE, MIN_PRICE, NOISE_SECONDS, ON_TIME_SECONDS, STATION_PATTERN


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_int(column: Column) -> Column:
    return column.try_cast("int")


def has_text(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def clock_part(clock: Column, index: int) -> Column:
    """One part of an ``h:mm:ss`` text as a number."""
    return to_int(F.get(F.split(clock, ":"), F.lit(index)))


def service_hour(clock: Column) -> Column:
    """Hour of day of a service-day clock, whose hours run past 24 after midnight."""
    return clock_part(clock, 0) % 24


def station_or_blank(stop_id: Column) -> Column:
    """Station found anywhere in a stop id, ``''`` where there is none."""
    return F.regexp_extract(stop_id, STATION_PATTERN, 1)


def station_or_null(stop_id: Column) -> Column:
    """Station at the start of a stop id, null where there is none."""
    return F.nullif(F.regexp_extract(stop_id, "^" + STATION_PATTERN, 1), F.lit(""))


def money(text: Column) -> Column:
    """``$1,234.00`` as a number."""
    return to_double(F.translate(text, "$,", ""))


def plausible_price(price: Column, low: float = MIN_PRICE, high: float = MAX_PRICE) -> Column:
    """The price, or null outside the closed range."""
    return F.when(price.between(low, high), price)


def usable_delay(delay: Column, limit: int = NOISE_SECONDS) -> Column:
    """True strictly inside the noise limit on both sides."""
    return (delay > -limit) & (delay < limit)


def is_on_time(delay: Column) -> Column:
    return F.abs(delay) <= ON_TIME_SECONDS


def is_late(delay: Column) -> Column:
    return delay > ON_TIME_SECONDS


def is_early(delay: Column) -> Column:
    return delay < -ON_TIME_SECONDS


def floor_minutes(seconds: Column) -> Column:
    """Whole minutes rounded down, so -90 seconds are -2 minutes."""
    return F.floor(seconds / 60)


def exact_sum(column: Column, digits: int = 6) -> Column:
    """Sum of doubles through decimals: the same result for any order of the rows."""
    return F.sum(column.cast(f"decimal(28,{digits})")).cast("double")


def exact_mean(column: Column, digits: int = 6) -> Column:
    """Mean of doubles through decimals: the same result for any order of the rows."""
    return F.try_divide(exact_sum(column, digits), F.count(column))


def utc_instant(wall_clock: Column) -> Column:
    """A zone-less UTC wall clock as an instant, whatever the session time zone is."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", origin, wall_clock))


def epoch_seconds(wall_clock: Column) -> Column:
    """Whole seconds since 1970 of a zone-less UTC wall clock."""
    return F.unix_seconds(utc_instant(wall_clock))
