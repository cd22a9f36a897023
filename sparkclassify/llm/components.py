"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _smallest_neighbour(pairs: DataFrame) -> DataFrame:
    """Smallest of ``u`` and its neighbours, per ``u``; combines before the
    exchange, so a node with very many edges is no hot group."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def _stars(pairs: DataFrame) -> DataFrame:
    return pairs.join(_smallest_neighbour(pairs), "u")


def _unsettled(e: DataFrame) -> int:
    """Nodes that keep ``e`` from being stars: larger ends with several
    smaller ones, or with larger ones of their own."""
    ends = e.select(F.col("v").alias("n"), F.lit(1).alias("v"), F.lit(0).alias("u")).unionByName(
        e.select(F.col("u").alias("n"), F.lit(0).alias("v"), F.lit(1).alias("u")))
    per_node = ends.groupBy("n").agg(F.sum("v").alias("v"), F.sum("u").alias("u"))
    return per_node.filter("v > 1 OR (v > 0 AND u > 0)").count()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``: the smallest
    node of its component.  Nulls and loops are ignored; no edge, no row.

    Each round links all larger neighbours of a node to the smallest one
    (large star), then the smaller ones likewise (small star), until only
    stars are left, after O(log^2 n) rounds.  One number reaches the driver.
    """
    e = settle(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
               .filter("u < v").distinct())
    for _ in range(most_rounds):
        if not _unsettled(e):
            return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = settle(_stars(both).filter("v > u").select(F.col("m").alias("u"), "v")
                       .filter("u < v").distinct())
        down = _stars(large.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = settle(down.select(F.col("m").alias("u"), "v")
                   .unionByName(down.select(F.col("m").alias("u"), F.col("u").alias("v")))
                   .filter("u < v").distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
