"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint, not null) -> one row per node of an edge: node, root (smallest reachable).

    Alternates two rewrites until nothing changes. In the first, every node hands its larger
    neighbours to its smallest one; in the second, its smaller ones. Each keeps the components,
    the number of edges never grows, and paths shrink to stars in a logarithmic number of rounds.
    Minima are combined before the shuffle, and the joins are plain equi-joins, so adaptive
    execution splits a hub. Every round is checkpointed; the driver sees two numbers a round.
    """
    now = _tidy(edges.select("a", "b"))
    mark = _mark(now)
    while mark[0]:
        now = _tidy(_hand_on(_hand_on(now, larger=True), larger=False))
        last, mark = mark, _mark(now)
        if mark == last:
            break
    stars = now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return cut(edges.filter("a <> b").select(big, small).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal marks mean equal edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _hand_on(edges: DataFrame, larger: bool) -> DataFrame:
    """``larger``: each node's larger neighbours go to its smallest neighbour or itself; else its
    smaller neighbours, and the node itself, go to the smallest of them."""
    if larger:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))
