"""Connected components by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.session import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Moves edges to the smallest neighbour; a node with many neighbours is joined, never gathered."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = near.join(least, "u")
    if both:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of an edge table (a, b); the component is its smallest node.

    Each round is written to the shared folder and takes time in proportion to the
    edges; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        large = _star(edges, both=True)
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = materialize(_star(large, both=False), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
