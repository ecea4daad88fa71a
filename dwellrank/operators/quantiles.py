"""Exact quantiles of groups of any size, without sorting a group or counting each of its values.

A round cuts every group at ``CUTS`` of its own approximate quantiles, counts exactly how many values lie at
and between the cuts, and goes on with the one gap that holds the rank asked for. A gap has about one part in
``CUTS`` of its group whatever the distribution, so the rounds grow with the logarithm of the largest group; a
value that repeats, however often, is a cut or alone in no gap. Groups of at most ``SMALL`` values are read off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.operators.skew import join_lookup
from dwellrank.session import pin, pin_measured

CUTS = 32
SMALL = 1024  # values of a group that one row may hold
ACCURACY = 1000

_GROUP = ["_g"]


def _ranks(probabilities: list[float], interpolated: bool) -> Column:
    """Rows (target, rank) of a group of ``_n`` values: one rank a probability, or the two it lies between."""
    found = []
    for i, p in enumerate(probabilities):
        if interpolated:
            low = F.floor((F.col("_n") - 1) * p).cast("long") + 1
            found += [(2 * i, low), (2 * i + 1, F.least(low + 1, F.col("_n")))]
        else:
            found.append((2 * i, F.greatest(F.ceil(F.round(F.col("_n") * p, 9)).cast("long"), F.lit(1).cast("long"))))
    return F.inline(F.array(*[F.struct(F.lit(t).alias("target"), r.alias("rank")) for t, r in found]))


def _cut(rows: DataFrame) -> DataFrame:
    """Per group its size and its cuts: approximate quantiles with the least and the largest value, ascending."""
    grid = F.percentile_approx("v", [i / CUTS for i in range(1, CUTS)], ACCURACY)
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.min("v")), grid, F.array(F.max("v")))))
    return pin(rows.groupBy("_g").agg(F.count("*").alias("_n"), cuts.alias("cuts")), "quantile-cuts")


def _read_off(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(root, target, value) of groups of bounded size."""
    lists = rows.groupBy("_g").agg(F.sort_array(F.collect_list("v")).alias("values"))
    return targets.join(lists, "_g").select("root", "target", F.get("values", (F.col("rank") - 1).cast("int")).alias("value"))


def exact_quantiles(
    df: DataFrame, key: str | None, value: str, probabilities: list[float], names: list[str], interpolated: bool = False, small: int = SMALL
) -> DataFrame:
    """``key``, n and the quantiles of ``value`` under ``names``, one row per key (or one row, without a key).

    A quantile is the least value with at least that share of values up to it, or with ``interpolated`` the value at
    rank ``(n - 1) * p`` on a straight line between its neighbours. Null values are left out, and keys without any
    other; a null key is a key. Not-a-number is the largest value. A key with most of the rows is cut like any other:
    tasks summarise before anything moves, and beyond the first round only rows in the gaps are read.
    """
    root = F.struct(F.col(key).alias("key") if key else F.lit(0).alias("key"))
    rows = df.select(root.alias("root"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    rows = rows.select("root", F.struct("root", F.lit("").alias("path")).alias("_g"), "v")
    cuts = _cut(rows)
    sizes = cuts.select(F.col("_g.root").alias("root"), "_n")
    targets = pin(cuts.select("_g", F.col("_g.root").alias("root"), "_n", _ranks(probabilities, interpolated)).drop("_n"), "quantile-targets")
    answers: list[DataFrame] = []
    while True:
        few = cuts.filter(F.col("_n") <= small).select("_g")
        answers.append(pin(_read_off(rows.join(few, "_g", "left_semi"), targets), "quantile-values"))
        many = cuts.filter(F.col("_n") > small).select("_g", "cuts")
        # The place of a value among the cuts: odd numbers are the cuts themselves, even ones the gaps before them.
        met = join_lookup(rows, many, "_g")
        below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
        code = 2 * below + F.when(F.get("cuts", below) == F.col("v"), 1).otherwise(0)
        coded = met.select("root", "_g", "v", code.alias("code"))
        counts = pin(coded.groupBy("_g", "code").agg(F.count("*").alias("k")), "quantile-counts")
        up_to = F.sum("k").over(Window.partitionBy("_g").orderBy("code").rowsBetween(Window.unboundedPreceding, 0))
        spans = counts.withColumn("upto", up_to)
        held = targets.join(spans, "_g").filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("k")))
        hit, counted = pin_measured(held.join(many, "_g"), "quantile-hits", open=F.count_if(F.col("code") % 2 == 0))
        at_cut = F.get("cuts", F.floor(F.col("code") / 2).cast("int"))
        answers.append(hit.filter("code % 2 = 1").select("root", "target", at_cut.alias("value")))
        if not counted["open"]:
            break
        inner = F.struct("root", F.concat(F.col("_g.path"), F.lit("/"), F.col("code")).alias("path"))
        still = hit.filter("code % 2 = 0")
        targets = pin(still.select(inner.alias("_g"), "root", "target", (F.col("rank") - F.col("upto") + F.col("k")).alias("rank")), "quantile-targets")
        gaps = still.select("_g", "code").distinct()
        rows = pin(coded.join(gaps, ["_g", "code"], "left_semi").select("root", inner.alias("_g"), "v"), "quantile-rows")
        cuts = _cut(rows)
    found = reduce(DataFrame.unionByName, answers).groupBy("root").pivot("target", [t for i in range(len(probabilities)) for t in ([2 * i, 2 * i + 1] if interpolated else [2 * i])]).agg(F.max("value"))
    both = sizes.join(found, "root")
    out = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        low = F.col(f"`{2 * i}`")
        if interpolated:
            share = (F.col("_n") - 1) * p - F.floor((F.col("_n") - 1) * p)
            # Halves are exact as a mean, as the usual median is.
            line = F.when(share == 0.5, (low + F.col(f"`{2 * i + 1}`")) / 2).otherwise(low + (F.col(f"`{2 * i + 1}`") - low) * share)
            low = F.when(share == 0, low).otherwise(line)
        out.append(low.alias(name))
    return both.select(*([F.col("root.key").alias(key)] if key else []), F.col("_n").alias("n"), *out)
