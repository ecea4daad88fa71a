"""Connected components of a table of links, in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.session import pin


def _finished(edges: DataFrame) -> bool:
    """Whether every node points at one other node, which points at none."""
    counts = edges.agg(F.count("*").alias("n"), F.count_distinct("u").alias("nodes")).first()
    return counts.n == counts.nodes and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node reachable) of all nodes in ``links`` (columns a and b).

    Alternating large-star and small-star steps (Kiveris et al.): every node points its larger neighbours,
    then its smaller ones, at the smallest. Edges never outnumber the links, a step is one combined
    aggregate and one join, and rounds grow with the logarithm of a component's size. Each round is
    written to the shared scratch folder, so that a lost executor does not replay the rounds before.
    """
    edges = pin(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while not _finished(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours of every node go to its smallest neighbour.
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u")
        large = large.select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # A node and its smaller neighbours go to the smallest of them.
        large = pin(large, "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = pin(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
    # Every node but the smallest of its component now points at that one.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
