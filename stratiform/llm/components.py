"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _follow(table: DataFrame, column: str, up: DataFrame) -> DataFrame:
    """``table`` with ``column`` replaced by its root where it has one."""
    roots = up.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
    return (table.join(roots, F.col(column) == F.col("_n"), "left")
            .withColumn(column, F.coalesce("_u", column)).drop("_n", "_u"))


def components(edges: DataFrame) -> DataFrame:
    """``node, up``: the smallest node of its component for every other node.

    ``edges`` has long columns ``a`` and ``b``. A round points each node to its
    smallest smaller neighbour, follows the pointers to their roots and
    contracts the edges by them; at least half of the nodes that still have
    edges vanish each round. Aggregates and joins only, each round stored, so
    a node with very many edges is never gathered in one task."""
    order = lambda e: e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(order(edges.select("a", "b")), "cc-edges")
    found = None
    while not edges.isEmpty():
        up = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "cc-up")
        while True:
            jumped = stored(_follow(up.select("node", "up", F.col("up").alias("old")), "up", up), "cc-jump")
            drop_stored(up)
            up = jumped.select("node", "up")
            if jumped.where("up <> old").isEmpty():
                break
        left = stored(order(_follow(_follow(edges, "a", up), "b", up)), "cc-edges")
        drop_stored(edges)
        edges = left
        found = up if found is None else stored(_follow(found, "up", up).unionByName(up), "cc-found")
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("up"))
