"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import settled


def _settled(edges: DataFrame) -> bool:
    """Whether all edges lead to the smallest node of their component: none goes on or forks."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.sum("in").alias("in"))
    return nodes.where("out > 1 or (out > 0 and in > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the component's smallest node.

    Edges are two columns a and b of long. Stars are pulled together in turns, larger neighbours
    to the smallest and then a node's smaller ones, until nothing changes, in a number of rounds
    that grows with the logarithm of the size. A node of many edges is reduced per task before
    the shuffle, and its join can be split.
    """
    edges = settled(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a != b").unionByName(lower.select("a", F.col("m").alias("b")))
        edges = settled(small.distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
