"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.layers import settle

MOST_ROUNDS = 60


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("b") % 1000003).alias("s")
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a long, b long); root is the smallest node reachable.

    Each round sends every node's neighbours to the smallest of them, which keeps components and
    shortens paths; rounds grow with the logarithm of the longest path. Minima are combined before
    they are shuffled, so a hub with many links spreads out. Each round is written to the shared
    folder, and only a count and two sums come back to the driver. Loops and repeats are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").dropDuplicates()
    e = settle(e, "links")
    seen = _digest(e)
    for _ in range(MOST_ROUNDS):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).dropDuplicates()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        e = settle(small.unionByName(lower.withColumnRenamed("m", "b")).dropDuplicates(), "links")
        now = _digest(e)
        if now == seen:
            roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).dropDuplicates()
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = now
    raise RuntimeError("components did not settle")
