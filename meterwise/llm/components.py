"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of `links` (a, b) but the smallest of each
    component, which names it.

    Alternates two steps until every edge leads to a node that leads nowhere, and every node
    has one edge: every node hangs its larger neighbours on
    its smallest one, then itself and its smaller ones. Paths halve each time. Both steps
    are map-side combined minima and joins that split hot nodes; each round is a written
    table, and only counts reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    linked = links.where(a != b)
    edges = written(
        linked.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges"
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = (
            both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (
            joined.where(b != F.col("m"))
            .select(b.alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        )
        edges = written(small.distinct(), "edges")
    return edges.select(a.alias("node"), b.alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether no node has two edges that lead down, or one that is led to has any."""
    down = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    up = edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    of_node = down.unionByName(up).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return of_node.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()
