"""Connected components by alternating large and small stars, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stage import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """node, component (the smallest reachable node) of every node of ``edges`` (a, b).

    Each round links every node to the smallest in its neighbourhood; rounds end when the
    edges are stars around the smallest node of each component and no longer change. Nodes of
    many neighbours are reduced before the shuffle; a skewed join is split by AQE.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = scratch.save(pairs.filter("u <> v").distinct(), f"{name}-0")
    state, k = _state(pairs), 0
    while True:
        k += 1
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = scratch.save(stars, f"{name}-{k}")
        before, state = state, _state(pairs)
        if k > 1:
            scratch.drop(f"{name}-{k - 2}")
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


def _state(pairs: DataFrame) -> tuple:
    """Count and an order-free checksum of the edges."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
