"""As-of joins: each row with the latest earlier row of another stream of the same keys.

Both streams are range-partitioned together by keys and time, so a key with most of the rows spreads over
many partitions. Inside a partition a running maximum carries the latest row forward. What a
partition needs from those before it is one row per key that crosses its edge, and at most two keys cross
the edges of a partition, so that table is as small as the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.session import pin_measured


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    time: str,
    tolerance: Column | None = None,
    prefix: str = "",
    how: str = "left",
) -> DataFrame:
    """``left`` with the other columns of the latest ``right`` row of equal keys and no later time.

    Both frames have the columns ``by`` and ``time``; times of one type that is a timestamp, a date or a number.
    ``tolerance`` is what may lie between the two times at most, as an interval or a number; an earlier row
    is no match. Of right rows with one time, the largest in order of their other columns is taken, so the
    result does not depend on the order of the input. ``prefix`` is put before the names that come from the right;
    its time comes as ``<prefix><time>_matched``. With ``how="left"`` rows without a match have nulls,
    with ``how="inner"`` they are left out. Null keys and null times match nothing; every left row gives one
    row at most, copies of it included.
    """
    others = [c for c in right.columns if c not in (*by, time)]
    names = [f"{prefix}{time}_matched", *[f"{prefix}{c}" for c in others]]
    clash = set(names) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides: give a prefix")
    keys = [f"_k{i}" for i in range(len(by))]
    found = F.struct(F.col(time).alias("t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])

    def laid(df: DataFrame, side: int, body: list[str], seen: Column) -> DataFrame:
        usable = F.lit(True)
        for c in (*by, time):
            usable &= F.col(c).isNotNull()
        known = [F.when(usable, F.col(c)).alias(k) for c, k in zip((*by, time), (*keys, "_t"))]
        row = F.struct(*[F.col(f"`{c}`").alias(f"l{i}") for i, c in enumerate(body)]) if side else F.lit(None)
        frame = df if side else df.filter(usable)
        return frame.select(*known, F.lit(side).alias("_side"), row.alias("_row"), seen.alias("_seen"))

    earlier = laid(right, 0, [], found)
    later = laid(left, 1, left.columns, F.lit(None).cast(earlier.schema["_seen"].dataType))
    both = earlier.withColumn("_row", F.lit(None).cast(later.schema["_row"].dataType)).unionByName(later)
    # Copies of one row, however many, are spread by their place.
    spread = both.withColumn("_copy", F.monotonically_increasing_id())
    order = [*keys, "_t", "_side", "_copy"]
    dealt, counted = pin_measured(
        spread.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "asof", last=F.max("_slice"),
    )
    inside = Window.partitionBy("_slice", *keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = dealt.withColumn("_seen", F.max("_seen").over(inside)).filter(F.col("_side") == 1)
    latest = F.col("_seen")
    if counted["last"] > 0:
        edges = dealt.filter(F.col(keys[0]).isNotNull()).groupBy("_slice", *keys).agg(F.max("_seen").alias("_last"))
        crossing = edges.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).drop("_n")
        before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ahead = (
            edges.join(crossing, keys)
            .select("_slice", *keys, F.max("_last").over(before).alias("_before"))
            .filter(F.col("_before").isNotNull())
        )
        # Fewer than two rows per range partition.
        carried = carried.join(F.broadcast(ahead), ["_slice", *keys], "left")
        latest = F.coalesce("_seen", "_before")
    if tolerance is not None:
        latest = F.when(F.col("_t") <= latest["t"] + tolerance, latest)
    matched = carried.withColumn("_found", F.when(F.col("_t").isNotNull(), latest))
    if how == "inner":
        matched = matched.filter(F.col("_found").isNotNull())
    return matched.select(
        *[F.col(f"_row.l{i}").alias(c) for i, c in enumerate(left.columns)],
        F.col("_found.t").alias(names[0]),
        *[F.col(f"_found.c{i}").alias(name) for i, name in enumerate(names[1:])],
    )
