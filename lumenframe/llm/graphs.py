"""Connected components of a graph of pairs, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node that can be reached from it.

    Alternating large and small stars: a node's greater neighbours, then its
    smaller ones, are tied to the least of all it knows. The graph never grows,
    a hub's rows are joined, not gathered, and the rounds grow with the
    logarithm of the longest path. Each round is written to the shared folder.
    """
    edges = B.checkpoint(_oriented(edges))
    seen = None
    while True:
        edges = B.checkpoint(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        seen = now


def _oriented(edges: DataFrame) -> DataFrame:
    """Each pair once, the greater node first."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _oriented(tied.union(least.select("a", F.col("least").alias("b"))))
