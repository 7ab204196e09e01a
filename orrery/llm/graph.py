"""Connected components of an edge table, by large-star and small-star steps.

A large-star step hangs every larger neighbour of a node on the smallest of its
neighbourhood, a small-star step does so with the node itself and its smaller
neighbours; repeated in turn they leave one star per component, in a number of
rounds that grows with the logarithm of its size.  Each step is a grouped
minimum and a join, so no task holds a node's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.util import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b; longs), root being the
    smallest node of its component and listed too.  Loops ``a = b`` and repeated
    edges change nothing; an empty table has no nodes."""
    now = staged(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        now = staged(_small_star(_large_star(now)), "edges")
    found = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
