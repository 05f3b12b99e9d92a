"""Connected components on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.storage import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge in ``edges(u, v)``: the smallest node that it reaches.

    In each round a node takes the least label around it, and then the label of that label, so that labels move over
    doubled distances. Rounds are written; neighbours are only joined and summed up, never gathered.
    """
    both = written(edges.select("u", "v").union(edges.select("v", "u")).filter("u <> v").distinct())
    labels = written(both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("component")))
    while True:
        around = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("least"))
        moved = labels.join(around, F.col("node") == F.col("u")).select("node", F.least("component", "least").alias("component"), F.col("component").alias("before"))
        of = moved.select(F.col("node").alias("n"), F.col("component").alias("further"))
        jumped = written(moved.join(of, F.col("component") == F.col("n")).select("node", F.least("component", "further").alias("component"), "before"))
        labels = jumped.select("node", "component")
        if jumped.filter("component <> before").isEmpty():
            return labels
