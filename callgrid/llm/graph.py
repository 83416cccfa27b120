"""Connected components by joins alone: alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node that links reach.

    Nodes are of any orderable type; null and self links are ignored. Each round maps an edge table to an equivalent one
    nearer to stars around the smallest nodes; rounds grow with the logarithm of the longest chain. A hub's edges meet
    only in aggregates with map-side combine and in joins with one row per node.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = written(e, "links"), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select("v", F.col("v").alias("root")).distinct()
            )
        before = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
