"""Connected components of links in a shuffle per round, without a driver-side graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

Store = Callable[[DataFrame, str], DataFrame]


def connected_components(links: DataFrame, store: Store) -> DataFrame:
    """node and root (the component's label) of every node that has a link.

    links: a, b. In each round every node points to its least neighbour, or to itself, and edges
    are drawn between the nodes pointed to; that ends after a number of rounds that grows with the
    logarithm of the input if labels are in no order, as hashes are. store writes a frame under a
    name and reads it back, so that no round is computed twice.
    """
    edges = store(links.where("a <> b").select("a", "b").distinct(), "edges_0")
    roots = None
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        points = store(both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("to")), f"points_{turn}")
        if roots is None:
            roots = points.select("node", F.col("to").alias("root"))
        else:
            moved = points.select(F.col("node").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"))
        roots = store(roots, f"roots_{turn}")
        turn += 1
        left = points.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        moved = edges.join(left, "a").join(right, "b").where("new_a <> new_b")
        edges = store(moved.select(F.least("new_a", "new_b").alias("a"),
                                   F.greatest("new_a", "new_b").alias("b")).distinct(),
                      f"edges_{turn}")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
