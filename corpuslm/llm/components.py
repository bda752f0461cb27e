"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import materialize


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that is not itself the smallest.

    Edges may be repeated and given in either direction; loops and nulls are left out. Each round is
    two joins of narrow rows, written in the shared folder; a hub's rows are only ever summed by
    partial minima or joined, where large partitions can be split. Rounds grow with the logarithm of
    the longest path.
    """
    held = edges.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
    held = materialize(held.where("big <> small").distinct(), "edges")
    while True:
        lowest = held.groupBy("big").agg(F.min("small").alias("low"))
        # done when each node has one edge, to a node that has none
        n, nodes = held.agg(F.count("*"), F.count_distinct("big")).first()
        parents = lowest.select(F.col("big").alias("small"))
        if n == nodes and held.join(parents, "small", "left_semi").isEmpty():
            return held.select(F.col("big").alias("node"), F.col("small").alias("component"))
        below = lowest.select(F.col("big").alias("small"), "low")
        stars = held.join(below, "small", "left").select("big", F.coalesce("low", "small").alias("small")).distinct()
        stars = materialize(stars, "large-star")
        lowest = stars.groupBy("big").agg(F.min("small").alias("low"))
        moved = stars.join(lowest, "big").where("small <> low").select(F.col("small").alias("big"), F.col("low").alias("small"))
        held = materialize(moved.union(lowest.select("big", F.col("low").alias("small"))).distinct(), "small-star")
