"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.session import stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over ``edges`` (hi > lo).

    Large: every larger neighbour of a node is hung on the node's least neighbour. Small: a
    node and its smaller neighbours are hung on the least of them. The least neighbour is an
    aggregate, joined back, so a node with very many neighbours is no single task's work.
    """
    if small:
        near = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    else:
        near = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionAll(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
    least = near.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
    joined = near.join(least, "node")
    if small:
        out = joined.select(F.col("other").alias("hi"), F.col("root").alias("lo")).unionAll(
            least.select(F.col("node").alias("hi"), F.col("root").alias("lo"))
        )
    else:
        out = joined.where("other > node").select(F.col("other").alias("hi"), F.col("root").alias("lo"))
    return out.where("hi <> lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), any order and repeats: rows (node, component) of all their nodes.

    ``component`` is the least node reachable. Every round is written to the staging folder,
    so a lost executor costs one round at most. Null ends and loops count for nothing.
    """
    now = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "edges",
    )
    while not _settled(now):
        now = stage(_star(_star(now, small=False), small=True), "edges")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    parents = edges.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
    loose = parents.where("n > 1").select("hi").unionAll(
        edges.select(F.col("lo").alias("hi")).join(parents.select("hi"), "hi", "left_semi")
    )
    return loose.isEmpty()
