"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import stage


def _large(edges: DataFrame, turn: int) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")), f"star-a{turn}")
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("hi"), F.least("m", "u").alias("lo")).filter("hi <> lo").distinct())


def _small(edges: DataFrame, turn: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = stage(edges.groupBy("hi").agg(F.min("lo").alias("m")), f"star-b{turn}")
    moved = (edges.join(least, "hi").filter("lo <> m")
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the
    smallest node of its component.

    Large-star and small-star contraction in turn: O(log^2 n) rounds, each a
    grouped minimum and an equi-join, each round written to the shared folder.
    The minimum is staged before it is joined, so a hub with many links is a
    skewed join side that adaptive execution can split.  Self links and null
    nodes are ignored; no links give an empty table.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                .distinct(), f"{name}-0")
    turn = 0
    while True:
        rows, heads = now.agg(F.count(F.lit(1)), F.countDistinct("hi")).first()
        if rows == 0:
            break
        chained = now.select("lo").distinct().join(now.select(F.col("hi").alias("lo")), "lo", "left_semi")
        if rows == heads and chained.isEmpty():
            break
        turn += 1
        now = stage(_large(now, turn), f"{name}-{turn}a")
        now = stage(_small(now, turn), f"{name}-{turn}b")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return stage(now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots), f"{name}-end")
