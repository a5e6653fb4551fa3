"""Connected components of a graph in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simlane.llm.common import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the least of the node and its neighbours. The minima are written, so that
    both sides of the join have an exchange of their own and the centre of a large star can be split over tasks."""
    both = _both(edges)
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the least of them."""
    edges = staged(edges)
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for each node that has an edge; edges are (a, b), a != b. Each round is
    written to the shared folder; rounds grow with the logarithm of the longest path. The minimum is taken before the
    shuffle and the join behind it can be split, so the centre of a large star is no hot key."""
    mark = None
    edges = staged(edges.where(F.col("a") != F.col("b")).distinct())
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(2**30)), F.sum(F.hash("a", "b").cast("long"))).first())
        if now == mark or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = now
        edges = staged(_small_star(_large_star(edges)))
