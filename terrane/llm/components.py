"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a join and an aggregate over the edges, so no component, however
large, is gathered in one task; a hub is only ever the key of a ``min``. Each
round is written to the shared folder, which also keeps the plan short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import stage, unstage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them. ``v < u`` in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge; ``component`` is the smallest node reachable.

    Empty edges give an empty result; loops and repeated edges change nothing.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ends = stage(ends.where("u > v").distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        # Equal tables have equal marks; a change that keeps all three is next to impossible.
        x = F.xxhash64("u", "v")
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(x), F.sum(x % 1_000_003)).first())

    now = mark(ends)
    while now[0]:
        # The stars are reached when a round changes nothing.
        after = stage(_small_star(_large_star(ends)), "edges")
        unstage(ends)
        ends, was, now = after, now, mark(after)
        if was == now:
            break
    return ends.select(F.col("u").alias("node"), F.col("v").alias("component")).union(ends.select("v", "v").distinct())
