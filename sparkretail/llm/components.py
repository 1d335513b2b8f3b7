"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import durable

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node itself, goes to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; the label is the smallest node.

    No step gathers a neighbourhood: each takes a minimum per node, which combines before
    the shuffle, and joins it back. Ends when a round changes nothing.
    """
    edges = durable(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _state(edges)
    if before[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    for _ in range(MAX_ROUNDS):
        edges = durable(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
