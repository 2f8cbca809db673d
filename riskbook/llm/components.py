"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.storage import store


def connected(edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component, as (node, root), for edges (a, b).

    Alternates two steps until the edges stay as they are: every node's larger neighbours move to
    its smallest neighbour, then its smaller ones do.  A step is a sum by node (pre-combined in each
    task) and a join on the node, so a node with very many edges is never gathered; each round's
    edges are written to the shared folder.  Nodes without an edge do not appear.
    """
    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(edges)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        # the larger neighbours of a node to the smallest of all
        edges = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # the smaller neighbours of a node, and itself, to the smallest of them
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        edges = (
            edges.join(least, "a")
            .where("b > least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
            .distinct()
        )
        edges = store(edges)
        now = _state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
