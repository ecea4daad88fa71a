"""Global ranks without passing all rows through one task.

Ranks depend only on how many rows lie below a value. Rows are first counted per distinct value,
which collapses any number of ties before the shuffle. The distinct values are range-partitioned, and a
running count inside each range plus the totals of the ranges before it gives the position. Row numbers range-partition the
rows themselves on a total order, so ties never share one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.operators.skew import hot_slices, join_splitting_hot_keys
from dwellrank.session import pin, pin_measured

MAX_BROADCAST_VALUES = 500_000  # rows of four numbers, about 32 MB before hashing

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these bits


class Positions(NamedTuple):
    """Per (measure, value): ``n_below``, ``n_equal``, ``n_total``; with what was counted of it.

    ``measure`` is the place of the column in ``columns``. Values have the columns' own type if that is
    one and the same, so that large integers stay apart; otherwise they are doubles.
    """

    table: DataFrame
    columns: list[str]
    n_values: int
    has_hot_value: bool


def value_positions(df: DataFrame, columns: list[str]) -> Positions:
    """Where each distinct value of each column stands among all rows. Nulls count as the lowest."""
    kinds = {df.schema[c].dataType for c in columns}
    values = [F.col(c) if len(kinds) == 1 else F.col(c).cast("double") for c in columns]
    if len(columns) == 1:
        keys = ["value"]  # sorting by the number alone is several times faster
        long = df.select(values[0].alias("value"))
    else:
        keys = ["measure", "value"]
        pairs = [F.struct(F.lit(i).alias("measure"), v.alias("value")) for i, v in enumerate(values)]
        long = df.select(F.inline(F.array(*pairs)))
    counts, counted = pin_measured(
        long.groupBy(*keys).agg(F.count("*").alias("n_equal")),
        "value-counts",
        n_values=F.count(F.lit(1)),
        n_most=F.max("n_equal"),
        n_rows=F.sum("n_equal"),
    )
    n_total = counted["n_rows"] // len(columns)
    table = _below_in_ranges(counts, keys[:-1]).select(
        F.col("measure") if "measure" in keys else F.lit(0).alias("measure"),
        "value",
        "n_below",
        "n_equal",
        F.lit(n_total).cast("long").alias("n_total"),
    )
    return Positions(table, columns, counted["n_values"], counted["n_most"] * hot_slices(df) > n_total)


def _running(column: str, by: list[str], order: str) -> Column:
    """Sum of the rows before this one."""
    window = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def _below_in_ranges(counts: DataFrame, by: list[str]) -> DataFrame:
    ranged = pin(
        counts.repartitionByRange(*by, "value").withColumn("slice", F.spark_partition_id()), "value-ranges"
    )
    # One row per measure and range partition: its size is bounded by the partition count.
    slices = (
        ranged.groupBy(*by, "slice")
        .agg(F.sum("n_equal").alias("n_slice"))
        .withColumn("n_before", _running("n_slice", by, "slice"))
    )
    return (
        ranged.withColumn("n_inside", _running("n_equal", [*by, "slice"], "value"))
        .join(F.broadcast(slices), [*by, "slice"])
        .withColumn("n_below", F.col("n_before") + F.col("n_inside"))
    )


def attach_positions(
    df: DataFrame, positions: Positions, column: str, max_broadcast: int = MAX_BROADCAST_VALUES
) -> DataFrame:
    """Add ``n_below``, ``n_equal`` and ``n_total`` of ``column`` to every row of ``df``.

    Positions are fixed-size rows, broadcast while their counted number allows it. Beyond that the join is
    shuffled, with hot values split off if there are any; ``df`` is then read twice.
    """
    table = positions.table.filter(F.col("measure") == positions.columns.index(column)).select(
        F.col("value").alias("_value"), "n_below", "n_equal", "n_total"
    )
    keyed = df.withColumn("_value", F.col(column).cast(positions.table.schema["value"].dataType))
    if positions.n_values <= max_broadcast or not positions.has_hot_value:
        if positions.n_values <= max_broadcast:
            table = F.broadcast(table)
        same = keyed["_value"].eqNullSafe(table["_value"])
        return keyed.join(table, same).select(*df.columns, "n_below", "n_equal", "n_total")
    share = F.try_divide(F.col("n_equal"), F.col("n_total"))
    return join_splitting_hot_keys(keyed, table, ["_value"], share).drop("_value")


def rank_from_position(descending: bool = True) -> Column:
    """Rank with gaps after ties, from attached positions."""
    ahead = F.col("n_total") - F.col("n_below") - F.col("n_equal") if descending else F.col("n_below")
    return ahead + 1


def percent_rank_from_position() -> Column:
    """Ascending percent rank from attached positions; 0 for a single row."""
    return F.coalesce(F.try_divide(F.col("n_below"), F.col("n_total") - 1), F.lit(0.0))


def with_rank(
    df: DataFrame, column: str, name: str, descending: bool = True, positions: Positions | None = None
) -> DataFrame:
    """Add the global rank of ``column``. ``df`` is read twice, so it should be a scan or pinned."""
    positions = positions if positions is not None else value_positions(df, [column])
    placed = attach_positions(df, positions, column)
    return placed.withColumn(name, rank_from_position(descending)).select(*df.columns, name)


def with_percent_rank(
    df: DataFrame, column: str, name: str, digits: int = 2, positions: Positions | None = None
) -> DataFrame:
    """Add the ascending percent rank of ``column``, rounded. ``df`` is read twice."""
    positions = positions if positions is not None else value_positions(df, [column])
    placed = attach_positions(df, positions, column)
    value = F.round(percent_rank_from_position(), digits)
    return placed.withColumn(name, value).select(*df.columns, name)


def with_row_number(df: DataFrame, order: list[Column], name: str, total: str | None = None) -> DataFrame:
    """Add global row numbers from 1 in the given order, which should be total (end in a key).

    ``total`` also adds the row count under that name. Each range partition is sorted once and its
    row places are read from the generated ids; the frame is pinned so they cannot change.
    """
    placed, counted = pin_measured(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", _ROW_BITS)),
        "row-places",
        n_rows=F.count(F.lit(1)),
        last_slice=F.max("_slice"),
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    if counted["last_slice"] > 0:
        # One row per range partition: bounded by the partition count.
        slices = (
            placed.groupBy("_slice")
            .agg(F.count("*").alias("_n"))
            .select("_slice", _running("_n", [], "_slice").alias("_before"))
        )
        placed = placed.join(F.broadcast(slices), "_slice")
        place = place + F.col("_before")
    added = [place.alias(name)]
    if total:
        added.append(F.lit(counted["n_rows"]).cast("long").alias(total))
    return placed.select(*df.columns, *added)


def ntile_from_row_number(k: int, row_number: str, total: str) -> Column:
    """Bucket 1..k of a row number: sizes differ by one at most, larger buckets first."""
    n, rn = F.col(total), F.col(row_number)
    small = F.floor(n / k)
    n_large = n % k
    in_large = n_large * (small + 1)
    late = n_large + F.floor(F.try_divide(rn - 1 - in_large, small)) + 1
    return F.when(rn <= in_large, F.floor((rn - 1) / (small + 1)) + 1).otherwise(late).cast("int")


def with_ntile(df: DataFrame, k: int, order: list[Column], name: str) -> DataFrame:
    """Add the bucket 1..k of every row in the given total order. The result reads a pinned frame."""
    numbered = with_row_number(df, order, "_rn", "_rows")
    return numbered.withColumn(name, ntile_from_row_number(k, "_rn", "_rows")).select(*df.columns, name)
