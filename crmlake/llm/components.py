"""Connected components of a graph given as links, by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crmlake.llm.shared import release

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node that can be reached.

    In each round every larger neighbour of a node is linked to the smallest node of its
    neighbourhood (large star), then every smaller one (small star), which shortens chains to stars in
    about log(n) rounds. A round ends in one checkpoint. A node's links are reduced by an aggregate
    before they are joined, and the joins are of a kind that adaptive execution splits where a node
    has very many links.
    """
    edges = (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .where("a <> b").distinct().checkpoint())
    known = _sums(edges)
    for _ in range(MOST_ROUNDS):
        release(links.sparkSession)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct().checkpoint())
        before, known = known, _sums(edges)
        if before == known:
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    label = edges.groupBy("a").agg(F.min("b").alias("label"))
    return (label.select(F.col("a").alias("node"), "label")
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))


def _sums(edges: DataFrame) -> tuple:
    """What tells two sets of links apart: their number and two hashes of them all."""
    hashes = [F.bit_xor(F.xxhash64("a", "b", F.lit(k))) for k in (1, 2)]
    return tuple(edges.agg(F.count("*"), *hashes).first())
