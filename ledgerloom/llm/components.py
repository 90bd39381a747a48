"""Connected components of a graph of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import write_shared


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node reachable.

    Alternates two steps until nothing changes: each node's larger neighbours are pointed at its smallest neighbour, then
    its smaller ones. The number of rounds grows with the logarithm of the longest path. Every round is written to the
    shared folder; the driver sees only counts. Minima are taken in parts before the shuffle, and the joins may be split
    where a node has many neighbours.
    """
    edges, before = write_shared(_ordered(edges), "components"), None
    while True:
        edges = write_shared(_ordered(_small_star(_ordered(_large_star(edges)))), "components")
        after = _digest(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)


def _ordered(edges):
    """Distinct edges with a > b."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    pointed = edges.join(least, "a")
    return pointed.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _digest(edges):
    """What two edge sets have in common only if they are the same: their size and order-free sums of hashes."""
    h = F.xxhash64("a", "b")
    return edges.agg(F.count("*"), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first()
