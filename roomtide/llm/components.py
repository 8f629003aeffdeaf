"""Connected components of an edge table, by alternating star operations.

Every round joins each node to the smallest node it knows, in two half steps that
together flatten long chains fast. Rounds are tables in the shared folder; the driver
sees one count and one sum a round. The smallest neighbours are written before they are
joined, so that Spark can split the edges of a node that has very many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour or itself."""
    near = _both(edges)
    least = materialise(near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")),
                        "least")
    return (near.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (moved.unionByName(least.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, component (its smallest node) for every node that has an edge (a, b)."""
    now = materialise(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        # The codes of all edges, summed: equal sums mean that nothing moved.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        now = materialise(_small_star(_large_star(now)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(now.select(F.col("b").alias("node"),
                                        F.col("b").alias("component")).distinct())
