"""Connected components of an edge table by alternating star contractions on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(low.select("u", F.col("m").alias("v"))).distinct()


def component_roots(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) with v the smallest node of u's component, for all nodes but the roots.

    ``edges`` holds rows (u, v) of comparable ids; direction, repeats and loops
    do not matter, null ends are dropped. Each round is two joins on the node,
    checkpointed; the rounds grow with the logarithm of the longest chain.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialise(edges), None
    for _ in range(max_rounds):
        edges = materialise(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            return edges
        before = tuple(state)
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
