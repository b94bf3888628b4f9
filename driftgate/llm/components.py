"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(edges: DataFrame) -> DataFrame:
    """Each node of ``edges`` (a, b: long) with the smallest node it is connected to: node, root.

    Rounds of two steps, which halve what is left to do: every node's larger neighbours, then its smaller ones, are
    linked to the least node it knows. Each round is one minimum per node, combined before the shuffle, and one join;
    its edges are written to the shared folder, so a lost executor costs one round at most.
    """
    edges = cut(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct()
        )
        own = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(own, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))))
            .select(F.col("col.a").alias("a"), F.col("col.m").alias("b")).filter("a <> b").distinct()
        )
        edges = cut(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
