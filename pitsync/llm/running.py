"""Positions and running sums over a whole table, without one task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitsync.llm.staging import stage

#: monotonically_increasing_id keeps the partition above these bits
_BITS = 33


def running(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], value: Column | None = None, label: str = "running") -> DataFrame:
    """``rows`` with ``before``, ``total`` and ``first``, in the order given.

    ``before`` is the sum of ``value`` (1 by default, so a position from 0) over the earlier
    rows of the same ``group``, ``total`` that over the whole group, and ``first`` a number
    that rises with the group in the order of the sort. Rows that agree in all columns of
    ``order`` follow each other in any order.

    The rows are range-sorted by group and order and written once, so a partition holds a
    stretch of them and a group of any size spreads over many. Sums of the stretches, one
    row per group and partition, say what lies before each; within a stretch a window adds
    up. No column of ``rows`` may be named like the three, or start with two underscores.
    """
    keys = [F.col(g).asc_nulls_first() for g in group]
    ordered = rows.withColumn("__value", F.lit(1).cast("long") if value is None else value)
    ordered = ordered.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stage(ordered.withColumn("__at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("__part", F.shiftright("__at", _BITS))

    stretches = placed.groupBy(*group, "__part").agg(F.sum("__value").alias("__sum"), F.min("__at").alias("__start"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        *[F.col(g).alias(f"__g_{g}") for g in group],
        F.col("__part").alias("__p"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__earlier"),
        F.sum("__sum").over(whole).alias("total"),
        F.min("__start").over(whole).alias("first"),
    )
    inside = Window.partitionBy(*group, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    same = F.col("__part") == F.col("__p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return summed.join(stretches, same).select(
        *[F.col(c) for c in rows.columns], (F.col("__earlier") + F.col("__inside")).alias("before"), "total", "first"
    )
