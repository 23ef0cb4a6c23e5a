"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.sources.staging import reliable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the larger (or the smaller) neighbours of each node, and in small steps the node, on its least neighbour."""
    both = edges.select("u", "v")
    if large:
        both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        return moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    return moved.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = reliable) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (a, b).

    Each step is one shuffled aggregate and join; ``cut`` cuts its lineage.  The number of rounds grows with the
    logarithm of the longest chain."""
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
        now = cut(_star(cut(_star(now, True)), False))
