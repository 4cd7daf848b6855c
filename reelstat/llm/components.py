"""Connected components of links between numbers, by alternating large and small stars.

Every step is a grouping with partial aggregation and a join, so a node with many links is spread
over tasks, and each round's links are written before the next one reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the links (a, b); a component is its smallest node."""
    edges = written(_ordered(links), "links")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _star(both, F.col("v") > F.col("u"))
        down = written(_ordered(large), "links")
        # Small star: each node's smaller neighbours, and the node itself, go to the smallest.
        lower = down.select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = _star(lower, F.lit(True)).unionAll(
            lower.groupBy("u").agg(F.min("v").alias("a")).select("a", F.col("u").alias("b"))
        )
        edges = written(_ordered(small), "links")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    found = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return found.unionAll(found.select(F.col("component").alias("node"), "component").distinct())


def _star(pairs: DataFrame, keep) -> DataFrame:
    """For each u the smallest of u and its v, linked to the v that ``keep`` admits."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(smallest, "u").filter(keep)
    return joined.select(F.least("m", "u").alias("a"), F.col("v").alias("b"))


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
