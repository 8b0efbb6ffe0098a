"""Connected components of a table of links, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (columns ``a, b``); the label is the smallest node it is tied to.

    Large-star and small-star steps in turn until the links no longer change: each step hangs the neighbours of a node on
    their smallest one. All work is grouped minima and joins, so a node with very many links is pre-aggregated and split.
    The tables between the rounds are written to the shared folder.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(least).where("a <> b").distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
