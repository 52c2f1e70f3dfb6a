"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.llm.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(sides: DataFrame, keep_larger_only: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and itself."""
    least = sides.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("least"))
    near = sides.where(F.col("b") > F.col("a")) if keep_larger_only else sides
    linked = near.join(least, near["a"] == least["node"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternates large-star and small-star steps until every edge leads to the smallest
    node of its component. A step takes the minimum per node, combined before the
    shuffle, and one join, in which Spark splits the partition of a hub. Each round is
    written to the shared folder. Edges with a null end are ignored.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stage(edges.distinct(), label)
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        large = stage(_star(_both_ways(edges), True), label)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        # small star: a node's smaller neighbours, and the node itself, go to the least of them
        least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        joined = down.join(least, down["a"] == least["node"])
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
        edges = stage(small.where(F.col("a") != F.col("b")).distinct(), label)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
