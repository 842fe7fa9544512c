"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settle


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One step. links(a, b) with a > b. Every node is tied to the smallest of its neighbours and itself."""
    if larger:
        near = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.join(least, "a")
    if larger:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link: root is the smallest node of its component.

    links(a, b), in any order, with repeats. A hot node's links are reduced by partial minima. Each step is
    checkpointed; the steps end when one changes nothing.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        edges = settle(_stars(_stars(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
