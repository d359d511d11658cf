"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.llm.store import saved

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge to another; component: the smallest node it reaches.

    `edges` has columns a and b of one ordered type; direction, repeats, loops and nulls do not matter. Each round ends
    in a written table. A node with many edges is reduced by a map-side minimum and joined by its
    neighbours' rows, which adaptive skew handling can split, so no task needs a whole neighbourhood.
    """
    now = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_ = _mark(now)
    for _ in range(ROUNDS):
        if not print_[0]:
            break
        now = saved(_small_star(_large_star(now)))
        before, print_ = print_, _mark(now)
        if before == print_:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """Changes whenever the edges do."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.union(least.select("a", F.col("m").alias("b"))).distinct()
