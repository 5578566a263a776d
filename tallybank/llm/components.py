"""Connected components of an undirected graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.common import lasting


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)."""
    both = pairs.unionByName(pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
    least = both.groupBy(F.col("lo").alias("node")).agg(F.min("hi").alias("other"))
    least = least.select("node", F.least("node", "other").alias("least"))
    return (both.join(least, F.col("lo") == F.col("node")).where(F.col("hi") > F.col("node"))
            .select(F.col("least").alias("lo"), "hi").distinct())


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = pairs.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least"))
    moved = (pairs.join(least, F.col("hi") == F.col("node")).where(F.col("lo") > F.col("least"))
             .select(F.col("least").alias("lo"), F.col("lo").alias("hi")))
    return moved.unionByName(least.select(F.col("least").alias("lo"), F.col("node").alias("hi"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")), F.countDistinct("lo")).first())


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of `pairs` (lo, hi; lo < hi): root is the smallest node of its component.

    Alternating large and small stars; the number of rounds grows with the logarithm of the longest path. Only three
    figures about a round reach the driver. Each round is written to the shared folder, so lineage stays short. Hubs are
    met by pre-aggregated minima and a join whose larger side is split at run time.
    """
    pairs = lasting(pairs.distinct())
    state = _state(pairs)
    while state[0]:
        after = lasting(_small_star(_large_star(pairs)))
        new = _state(after)
        pairs = after
        if new == state:
            break
        state = new
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
