"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.sources.staging import Staging


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the smallest node names it.

    Alternates large-star and small-star steps: every node hands its larger, then its
    smaller neighbours to the smallest one it knows. The table never has more rows than
    edges, no neighbour list is collected, and a hub is a skewed join that can be split.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current, before, step = staging.table(ordered.distinct(), f"{name}-0"), None, 0
    while (mark := _mark(current)) != before:
        before, step = mark, step + 1
        both = current.union(current.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a").where(F.col("b") != F.col("low"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(least)
        )
        current = staging.table(small.distinct(), f"{name}-{step}")
        staging.drop(f"{name}-{step - 1}")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
