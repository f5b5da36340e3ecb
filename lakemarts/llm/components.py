"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.frames import written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of these."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, and no ``v`` is a ``u`` itself."""
    nodes = edges.groupBy("u").agg(F.count("*").alias("n"))
    if not nodes.filter("n > 1").isEmpty():
        return False
    inner = edges.select(F.col("v").alias("u")).distinct()
    return inner.join(nodes, "u", "left_semi").isEmpty()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node with an edge.

    Each step aggregates before it joins, so a node with very many neighbours is
    no more than a skewed join key. Every step is written, and the number of steps
    grows with the logarithm of the longest chain. Loops and repeated edges are fine.
    """
    current = written(
        edges.select(
            F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
        )
        .filter("u > v")
        .distinct()
    )
    while not _is_forest_of_stars(current):
        current = written(_small_star(_large_star(current)), replaces=current)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
