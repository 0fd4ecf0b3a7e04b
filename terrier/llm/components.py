"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    moved = near.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node itself, move to the smallest of them."""
    near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    moved = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionAll(own).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the edges ``(a, b)``; a component is its smallest node.

    Each round is written to the shared folder, so that the plan doesn't grow and a lost executor
    costs no more than the round at work. The rounds end when the edges no longer change.
    """
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        edges = materialize(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
