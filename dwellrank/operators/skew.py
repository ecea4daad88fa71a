"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.session import pin, pin_measured

MAX_BROADCAST_ROWS = 500_000  # rows of a few short columns, about 32 MB


def hot_slices(df: DataFrame) -> int:
    """A key is hot when it holds more than one part in this many of the rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)


def _same_keys(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in on])


def join_splitting_hot_keys(left: DataFrame, right: DataFrame, on: list[str], share: Column) -> DataFrame:
    """Inner join on null-safe keys, where ``right`` has one row per key.

    ``share`` is computed on ``right``: the fraction of ``left`` rows that carry the key. A key is hot
    above one part in the number of shuffle partitions, so there are fewer hot keys than partitions
    and broadcasting them is safe by count. Hot rows join without a shuffle, the rest are shuffled
    and no remaining key is larger than a partition.
    """
    limit = 1.0 / hot_slices(left)
    hot = right.filter(share > limit)
    cold = right.filter(~(share > limit))
    keep = left.columns + [c for c in right.columns if c not in on]

    def joined(rows: DataFrame, table: DataFrame) -> DataFrame:
        renamed = table.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in table.columns])
        same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(renamed[f"_r_{k}"]) for k in on])
        return rows.join(renamed, same, "inner").select(*keep)

    hot_keys = F.broadcast(hot.select(*on))
    rest = left.join(hot_keys, _same_keys(left, hot_keys, on), "left_anti")
    return joined(left, F.broadcast(hot)).unionByName(joined(rest, cold))


def join_lookup(
    facts: DataFrame, lookup: DataFrame, on: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Inner join of facts with a lookup that has one row per key.

    The lookup is pinned and counted. It is broadcast up to ``max_broadcast_rows``; beyond that the
    rows per key are counted, which combines before its shuffle, and hot keys are split off.
    """
    table, counted = pin_measured(lookup, "lookup", n_rows=F.count(F.lit(1)))
    added = [c for c in table.columns if c != on]
    if counted["n_rows"] <= max_broadcast_rows:
        return facts.join(F.broadcast(table), on).select(*facts.columns, *added)
    counts = facts.groupBy(on).agg(F.count("*").alias("_n"))
    weighted = pin(table.join(counts, on), "weighted-lookup")
    total = weighted.agg(F.sum("_n")).scalar()
    known = facts.filter(F.col(on).isNotNull())
    return join_splitting_hot_keys(known, weighted, [on], F.try_divide(F.col("_n"), total)).select(
        *facts.columns, *added
    )


def with_salts(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` column that splits the hot keys of ``left``.

    Keys above one part in the number of shuffle partitions get as many salts as they hold such parts;
    the matching ``right`` rows are repeated once per salt. Add ``_salt`` to the equality condition:
    every left row still meets every right row of its key exactly once, for inner and left joins.
    """
    parts = hot_slices(left)
    counts = pin(left.groupBy(*on).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    size = max(total / parts, 1.0)
    # Fewer than `parts` rows by construction.
    hot = F.broadcast(
        counts.filter(F.col("_n") > size).select(*on, F.ceil(F.col("_n") / size).cast("int").alias("_salts"))
    )
    # Rows get their salts in turn, so equal rows are split as well.
    turn = left.withColumn("_turn", F.monotonically_increasing_id())
    picked = F.pmod(F.col("_turn"), F.coalesce(F.col("_salts"), F.lit(1)))
    salted_left = turn.join(hot, on, "left").withColumn("_salt", picked.cast("int")).drop("_salts", "_turn")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    salted_right = right.join(hot, on, "left").withColumn("_salt", every).drop("_salts")
    return salted_left, salted_right
