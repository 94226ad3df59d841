"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b, distinct).  Large: each node ties its larger neighbours to its least
    one; small: each node ties its smaller neighbours to the least of them."""
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        tied = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = edges.join(least, "a").select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
        # a node keeps its own tie to the least neighbour as well
        tied = tied.union(least.select("a", F.col("m").alias("b")))
    return tied.where("a > b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b): the least id that it reaches.

    Works on distributed tables only; each round is written to the shared folder, which
    cuts the lineage.  A hub's edges are never collected: only a minimum by node is.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now = cut(pairs, "edges")
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = mark(now)
    if seen[0]:
        for _ in range(rounds):
            after = cut(_star(_star(now, True), False), "edges")
            drop(now)
            now, before, seen = after, seen, mark(after)
            if before == seen:
                break
        else:
            raise RuntimeError("components did not settle")
    leaves = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return leaves.union(now.select("b", "b").distinct())
