"""Connected components of an edge table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.plans.runtime import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b) of longs; nodes without edges are absent.

    Each round rewires every node's larger neighbours, then its smaller ones, to the smallest one;
    all states are written tables, nothing is collected but one checksum a round.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _checksum(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = written(small, "edges")
        after = _checksum(edges)
        if after == mark:
            break
        mark = after
    # every edge now leads from a node to its root
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _checksum(edges: DataFrame):
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).head())
