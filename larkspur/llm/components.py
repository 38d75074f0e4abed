"""Connected components by alternating stars: no driver-side graph, no whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the least node it reaches.

    Each round points the larger neighbours of a node at its least neighbour, then the
    smaller ones; the edges become one star per component after about log(n) rounds.
    Loops and repeated edges are harmless, no edges give no rows. Each round is a stored
    table, so lost executors repeat one round at most. Minima are aggregated map-side, so
    a node with very many neighbours is not one task's work.
    """
    state = durable(_ordered(edges.select("a", "b")).distinct())
    mark = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
        state = durable(_small(_large(state)))
    root = state.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return root.unionByName(state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    return moved.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a != b").unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
