"""Connected components by alternating large-star and small-star steps.

Every step is a join and an aggregation over edges; nothing but two numbers a round reaches the
driver. Each round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that is not itself the smallest.

    Self-loops, repeated edges and nulls are dropped; nodes without edges are not listed.
    """
    e = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a <> b").distinct()
    now = Stored(e, "edges")
    was, rounds = _signature(now.df), 0
    while was[0]:
        nxt = Stored(_small_star(_large_star(now.df)), "edges")
        now.drop()
        now, rounds = nxt, rounds + 1
        if (is_now := _signature(now.df)) == was:
            break
        was = is_now
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
