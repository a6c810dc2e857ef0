"""Connected components as a loop of min-aggregations and joins.

Each round runs one *large star* and one *small star* step over the edge table, so the number of rounds
grows with the logarithm of the longest chain and not with its length. A node with very many neighbours
costs one partial ``min`` per task and one join that adaptive execution can split, never a collected
neighbour list. Of up to ``FUSED_EDGES`` edges a round is one job; of more, each step of it is a written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from brandbook.session import materialise

FUSED_EDGES = 1_000_000
Keep = Callable[[DataFrame, str], DataFrame]


def _minima(links: DataFrame, keep: Keep) -> DataFrame:
    """For every node the least of itself and its neighbours, as a table of its own (plain join side)."""
    return keep(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame, keep: Keep) -> DataFrame:
    links = _both_ways(edges)
    return links.join(_minima(links, keep), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, keep: Keep) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _minima(down, keep)
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of one orderable type to ``(node, component)``, the least node of each component.

    Nulls, self-loops and repeated edges are ignored. Only nodes with an edge are returned; a table
    without edges gives no rows. Raises if ``max_rounds`` is not enough (2^60 nodes in a chain).
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = _mark(edges)
    if not mark[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    keep = materialise if mark[0] > FUSED_EDGES else lambda df, _: df
    for _ in range(max_rounds):
        edges = materialise(_small_star(keep(_large_star(edges, keep), "large"), keep), "edges")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
