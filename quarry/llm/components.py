"""Connected components by alternating large-star and small-star rounds.

Each round is two small aggregations and joins over the edges, written to the
shared folder; the number of rounds grows with the logarithm of the longest
path.  A star's centre is met by partial aggregation and by skew-split joins; no
side is broadcast, as both grow with the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Stages


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least.hint("merge"), "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): the smallest node of its
    component, for every node that has an edge."""
    now = stages.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    before, k = _digest(now), 0
    while before[0]:
        k += 1
        large = stages.write(_large_star(now), f"large-{k}")
        new = stages.write(_small_star(large), f"edges-{k}")
        stages.drop(f"large-{k}")
        stages.drop(f"edges-{k - 1}")
        now, after = new, _digest(new)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
