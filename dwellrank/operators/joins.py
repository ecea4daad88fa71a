"""Lookup and total joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.functions.scalars import station_or_blank, station_or_null
from dwellrank.session import pin


def attach_group_total(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """Put the sum of ``measure`` per ``key`` beside every row of an aggregate.

    The aggregate is pinned, so what is behind it runs once, and its totals are joined back: a window
    over the key would bring all rows of a large group into one task, while Spark splits a crowded key of
    this join. A null key is a group like any other.
    """
    groups = pin(df, "groups")
    totals = groups.groupBy(F.col(key).alias("_key")).agg(F.sum(measure).alias(name))
    return groups.join(totals, F.col(key).eqNullSafe(F.col("_key")), "left").select(*df.columns, name)


def possible_keys(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that every key of ``keys`` passes, and of the others one in 16 or fewer, up to 4 million keys.

    The test looks up one bit in a bitmap of the keys' hashes, 8 MB at most; with more keys more of the others
    pass. ``keys`` is read twice.
    """
    words = 1 << min((keys.count() // 4).bit_length(), 20)

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(64 * words))

    bits = keys.select(place(F.col(key)).alias("place")).selectExpr(
        "shiftright(place, 6) as word", "shiftleft(1L, cast(place & 63 as int)) as bits"
    )
    empty = keys.sparkSession.range(words).selectExpr("id as word", "0L as bits")
    filled = bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bitmap = pin(filled.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all")).select("all.bits"), "key-bitmap")

    def test(value: Column) -> Column:
        at = place(value)
        word = F.get(bitmap.scalar(), F.shiftright(at, 6).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return test


def with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``keys`` (a pinned table); only rows that may be among them move."""
    return rows.filter(possible_keys(keys, key)(F.col(key))).join(keys, key, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``keys`` (a pinned table); only rows that may be among those move."""
    test = possible_keys(keys, key)(F.col(key))
    return rows.filter(~test).unionByName(rows.filter(test).join(keys, key, "left_anti"))


def station_areas(lookup: DataFrame) -> DataFrame:
    """One area per station: the one of its smallest stop id."""
    return (
        lookup.withColumn("station", station_or_null(F.col("stop_id")))
        .dropna(subset=["station"])
        .groupBy("station")
        .agg(F.min_by("neighbourhood", "stop_id").alias("neighbourhood"))
    )


def area_stations(lookup: DataFrame) -> DataFrame:
    """Distinct (area, station) pairs; a stop id without a station counts as the blank station."""
    return lookup.select("neighbourhood", station_or_blank(F.col("stop_id")).alias("station_id")).distinct()


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep one whole row per key, the smallest in column order."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")
