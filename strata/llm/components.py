"""Connected components of a graph of edges, by alternating large and small stars.

Every round reads and writes the edges in the shared checkpoint folder; nothing of their number
reaches the driver but a count. A node of very many edges costs no more than its edges: each round
takes minima by aggregation and joins them back, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and itself.

    A large star keeps the larger neighbours, a small star the smaller ones and the node itself.
    ``edges`` has ``a`` above ``b``.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return linked.where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge (``a``, ``b``)."""
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "component-edges", few=True)
    for _ in range(rounds):
        new = stored(_stars(_stars(now, True), False), "component-edges", few=True)
        # done when every node has one edge, to a node that has none: all stars, rooted at their smallest
        tops = new.groupBy("a").agg(F.count("*").alias("n"))
        open_ = tops.where("n > 1").select("a").unionByName(new.select(F.col("b").alias("a")).join(tops, "a", "left_semi"))
        if open_.isEmpty():
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = new
    raise RuntimeError(f"components not found in {rounds} rounds")
