"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v) with u > v."""
    sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    lowest = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(lowest, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge: root is the smallest node reachable.

    ``edges``: columns a, b (long). Each round runs two joins of the edges
    with per-node minima (summed up before the shuffle, so a node with very
    many links is no bottleneck) and is written to the shared folder; the
    rounds end when the edges stay the same.
    """
    edges = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    seen = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
        if now == seen or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = now
        edges = materialize(_star(_star(edges, True), False), "edges")
