"""Connected components by alternating stars, on shared storage between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunagrid.llm.storage import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Each round links every node's larger neighbours to its smallest one, then every node and its
    smaller neighbours to the smallest of them; once nothing changes, each node is linked to its
    component's smallest node only. Rounds grow with the logarithm of the longest path.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        last, current = current, stored(small.where("a <> b").distinct(), "small-star")
        dropped(last, large)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
