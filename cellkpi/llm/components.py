"""Connected components of an edge table, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellkpi.llm.common import materialise

MAX_ROUNDS = 60
#: Up to so many edges the least neighbours of all nodes (16 bytes each) are
#: broadcast; beyond it the joins shuffle. The rows are the same.
BROADCAST_EDGES = 200_000


def _with_least(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    return edges.join(F.broadcast(least) if small else least, "a")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Every larger neighbour of u moves to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _with_least(both.where("b > a"), least, small).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(edges, least, small).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b), the root (the smallest node
    of the component) included. Edges may repeat; loops and nulls are ignored.
    Each round is written to the shared folder; stars of any size only pass
    through partial aggregates and joins that Spark can split."""
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    sign = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if mark == sign or not mark[0]:
            break
        sign = mark
        small = mark[0] <= BROADCAST_EDGES
        now = materialise(_small_star(_large_star(now, small), small).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
