"""Connected components of an edge table, by alternating large-star and small-star steps.

Only counts reach the driver.  The edges of a node with very many are dealt over several tasks.  Every round's edges become a table in the shared
folder, so that lineage stays short and a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import join_dealt, settle


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v bigint); component is the smallest node of its class.

    Null ends and self-loops are ignored; an empty table gives an empty one.
    """
    now = settle(edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    before = None
    while True:
        # A forest of stars is a fixed point: u is the smallest node and the only neighbour of each v.
        state = tuple(now.agg(F.count("*"), F.sum("u"), F.sum("v"), F.sum(F.hash("u", "v").cast("long"))).first())
        if state == before or state[0] == 0:
            break
        before = state
        both = _both(now)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = join_dealt(both, low, "u", "v").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v")
        # Small star: every node's smaller neighbours, and itself, hang on the smallest of them.
        down = settle(large.select(F.col("v").alias("x"), F.col("u").alias("w")).distinct(), now)
        least = down.groupBy("x").agg(F.min("w").alias("m"), F.count("*").alias("n"))
        small = join_dealt(down, least, "x", "w").where("w <> m").select(F.col("m").alias("u"), F.col("w").alias("v"))
        now = settle(small.unionByName(least.select(F.col("m").alias("u"), F.col("x").alias("v"))).distinct(), down)
    leaves = now.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return leaves.unionByName(roots)
