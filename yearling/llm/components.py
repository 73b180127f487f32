"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.sources.staging import discard, staged


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest one.

    The minimum is summed up before the shuffle and joined back, so that a node with
    many neighbours is no single task's work.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u > v")
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).where("u > v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (the smallest node reachable) of every linked node.

    `links` has columns `a` and `b`. Every round halves long paths, each is written
    to the shared folder, and the rounds end when the edges no longer change.
    """
    edges = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _mark(edges)
    while before[0]:
        old, edges = edges, staged(_small(_large(edges)), "edges")
        discard(old)
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots.distinct())
