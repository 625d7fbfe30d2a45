"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins and two aggregates on node keys, whose result is
written to the shared checkpoint folder; the number of rounds grows with the
logarithm of the longest path.  No node's neighbours are gathered: minima are
pre-aggregated, and a hot centre's rows are split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs in any direction -> (node, root) for every node that isn't its component's smallest.

    Loops and rows with nulls are ignored; repeated edges count once.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        print_ = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                         F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
        if tuple(print_) == state or not print_["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(print_)
        now = stored(_small_star(_large_star(now)))
