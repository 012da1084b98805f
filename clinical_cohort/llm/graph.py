"""Connected components over an edge table, by alternating star contractions.

Every round is two joins and groupings over the edges; the edges are written to
the shared checkpoint folder between rounds (a round's are removed after the next), so lineage stays short and an
executor's loss costs one round's tasks. Only two counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the edges (a, b); root is the smallest node reachable. Roots themselves are left out.

    Ends when every edge points at a root that no edge leaves, which both
    contractions then keep. An empty edge table gives an empty result.
    """
    current = saved(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        before, current = current, saved(_small_star(_large_star(current)), "edges")
        discard(before)
        # A forest of stars: one edge per node, and no root is itself a node.
        n = current.agg(F.count("a").alias("n"), F.count_distinct("a").alias("d")).first()
        if n["n"] == n["d"] and current.join(
                current.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count() == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
