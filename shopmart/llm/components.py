"""Connected components of a stored edge list by alternating star operations.

Every round points the larger neighbours of a node, then the smaller ones, at
the smallest node around. Rounds grow with the logarithm of the size of a
component, not with the length of its paths. Each round is written to the
shared folder, so no lost executor costs more than a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v) with u != v, both long; the root is the smallest node."""
    edges = cut_lineage(edges.select("u", "v").where("u != v").distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = cut_lineage(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
