"""Connected components by alternating large-star and small-star, on DataFrames of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.storage import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges go from the larger node u to the smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _tangled(edges: DataFrame) -> bool:
    """Whether any node has two smaller neighbours, or has one and is one: if not, the edges are stars, one a component."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("low")).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("low")))
    counts = roles.groupBy("node").agg(F.sum("low").alias("lows"), F.min("low").alias("least"))
    return not counts.filter("lows > 1 or (lows = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge in ``edges(u, v)``: the smallest node it reaches.

    Rounds go on until only stars are left, about log of the longest chain; each is written to the shared folder. Edges
    of a node with very many neighbours are only grouped with map-side sums and joined, so they are never in one task.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    while True:
        edges = written(_small_star(_large_star(edges)))
        if not _tangled(edges):
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
