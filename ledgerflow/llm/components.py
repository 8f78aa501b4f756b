"""Connected components over stored edges by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import store


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, least) with the smallest of u and its neighbours in ``edges`` (u, v)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.filter("v > u").join(_smallest(both), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them; edges run from large to small."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def component_of(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v); the component is its smallest node.

    Each round is stored; rounds end when the edges no longer change. Their number grows with the logarithm of the
    longest chain, and no node's neighbours are gathered in one place."""
    current = store(_small_star(edges.filter("u <> v")), "star_edges")
    before = _signature(current)
    while True:
        current = store(_small_star(_large_star(current)), "star_edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
