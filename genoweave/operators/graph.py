"""Connected components and Markov clustering of weighted gene graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.lineage import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of every node on an edge; single linkage of the pairs.

    Star contraction: each round hangs a node's larger neighbours, then its smaller ones, on its smallest neighbour;
    every component ends as a star in a logarithmic number of rounds. Rounds are cut by checkpoints, and their end is
    seen by one aggregate. Null ends are dropped; self edges make a component of one node.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes = pairs.select("u").union(pairs.select("v")).distinct()
    state = cut(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        state = cut(hung.union(small.select("u", "m")).distinct())
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    top = state.groupBy("u").agg(F.min("v").alias("m"))
    return nodes.join(top, "u", "left").select(F.col("u").alias("node"), F.coalesce("m", "u").alias("component"))
