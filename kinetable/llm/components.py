"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import Stored


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node reachable.

    Self links and repeated links are allowed; a node without a link to another is not returned.
    Every round is two joins on the node with a pre-aggregated minimum and is written to the
    shared scratch folder, so its lineage stays short and a lost executor costs one round at
    most. Only a row count and a checksum reach the driver. The number of rounds grows with the
    logarithm of the longest path; ``max_rounds`` only guards against an endless loop.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, seen = Stored(pairs, label), None
    for _ in range(max_rounds):
        now = state.df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or now[0] == 0:
            return state.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                state.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = now
        after = Stored(_small_star(_large_star(state.df)), label)
        state.drop()
        state = after
    raise RuntimeError(f"components: no end after {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to its smallest."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node sends itself and its smaller neighbours to its smallest; edges point down (u > v)."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()
