"""Connected components of an edge table, by large-star and small-star steps, each cut from its lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchcast.shared import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node that can be reached.

    Minima are aggregated before each exchange and joined back, so a node of very many edges is never gathered in one task."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = cut(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if mark == seen:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
