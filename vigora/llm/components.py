"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigora.llm.common import checkpointed, release


def follows(column: str) -> Column:
    """A second key of a sum, which follows from the first, so that the groups stay the same.

    A sum by one key is dealt as a join by that key, so Spark would join it in
    place, with all rows of a hot key in one task. Dealt by two keys, the sum is
    dealt anew for the join, and adaptive execution splits the hot key.
    """
    return F.shiftright(column, 62).alias("_follows")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a", follows("a")).agg(F.least(F.min("b"), F.col("a")).alias("m")).drop("_follows")
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, are tied to the least of them; edges go from small a to large b."""
    least = edges.groupBy("b", follows("b")).agg(F.min("a").alias("m")).drop("_follows")
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(joined.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that keep ``edges`` (a, b) from being stars: larger ends that have a second edge."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("larger")).union(edges.select(F.col("b").alias("node"), F.lit(1).alias("larger")))
    return ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.count("*").alias("edges")).where("larger > 0 AND edges > 1")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """node, component (the least node that is reached) for every node of ``edges`` (a, b; longs).

    Ends when the edges are stars; the rounds grow with the logarithm of the
    largest component. All groups are sums or joins against one row a node, so a
    node with very many edges is split like any skewed join. After each round the
    driver lets go of the round's plans and shuffle files.
    """
    now = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    for k in range(rounds + 1):
        if not _unsettled(now).count():
            break
        if k == rounds:
            raise RuntimeError("components did not settle")
        now = checkpointed(_small_star(_large_star(now)))
        release(now.sparkSession)
    return now.select(F.col("b").alias("node"), F.col("a").alias("component"))
