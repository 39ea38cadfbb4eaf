"""Connected components of links by alternating large-star and small-star steps, all on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """links: columns a, b (long). Returns node, component: for each node of a link the smallest node it reaches.

    Links of a node with itself or with null are ignored; no links give no rows. Each round keeps at most as many
    edges as before and is written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    seen = None
    while (mark := _mark(edges)) != seen:
        seen = mark
        if not mark[0]:
            break
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), label)
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(edges.select("v", "v").distinct().toDF("node", "component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
