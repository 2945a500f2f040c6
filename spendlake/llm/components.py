"""Connected components of an edge table, by alternating stars over shuffles."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.frames import stored


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v): every node but the smallest of its component, with that smallest node.

    Each round hooks neighbours to the smallest one seen (large star, then small star), which
    keeps the components and needs a number of rounds that grows with the logarithm of their
    diameter. Edges are written between rounds; minima are combined before the shuffle."""
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    state = _state(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # after a large star every edge points down (u > v); link the lower neighbours of u to their least
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        e = stored(small.filter("u != v").distinct(), "edges")
        now = _state(e)
        if now == state:
            return e
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
