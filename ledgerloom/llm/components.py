"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and all its neighbours. The minimum combines before the shuffle; the
    join back is an equi-join, which Spark splits where one node has very many edges."""
    smallest = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
    joined = edges.join(smallest, edges["u"] == smallest["node"])
    return joined.select("u", "v", F.least("u", "low").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_smallest(both).where("v > u")
    return moved.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = _with_smallest(down)
    moved = low.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """`links` (a, b: long) -> (node, component): every node of a link between different nodes, with the smallest
    node reachable. Nulls and self-links are dropped; no links give no rows. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain."""
    edges = links.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    # At the fixed point every edge points from a node to its component.
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
