"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge (a, b); root is the smallest node reachable.

    Alternating star steps: nodes point to the smallest neighbour, first from larger
    neighbours, then from smaller ones, until nothing changes. A step is a minimum per
    node, combined before its shuffle, and a join of the edges with those minima, whose
    large keys Spark splits. Each round is a written table, so no lineage grows, and
    neither edges nor components come to the driver. Null ends, loops and repeated edges
    are left out; no edges give no rows.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(ends.where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = staged(_small_star(_point(both, larger=True)), "edges")
        # The steps stop changing a table once it is a set of stars around the roots.
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == state:
            return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
                    .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
        state = after


def _point(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: the larger neighbours of each node point to its smallest neighbour or itself."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (edges.join(least, "a").where("b > a" if larger else "b < a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node itself point to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
