"""One row per key, latest k per key, and reports on repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitsync.functions.names import require
from pitsync.functions.ordering import By, OrderKey, content_tiebreak, order_columns


def latest_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderKey],
    n: int = 1,
    ties: Sequence[OrderKey] | None = None,
    rank_column: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key in ``order``; NULL keys form one group.

    ``row_number() <= n`` lets Spark place a WindowGroupLimit before the shuffle: each
    map task sends at most ``n`` rows per key, however hot the key is. Without ``ties``
    a hash of the row completes the order, so that reruns agree.
    """
    last = order_columns(ties) if ties is not None else [content_tiebreak(df)]
    window = Window.partitionBy(*[require(df, k) for k in keys]).orderBy(*order_columns(order), *last)
    rank = rank_column or "__rank"
    kept = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    return kept if rank_column else kept.drop(rank)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderKey],
    ties: Sequence[OrderKey] | None = None,
) -> DataFrame:
    """One row per key: the first in ``order`` (a plain name is descending, NULLs first)."""
    return latest_n_per_key(df, keys, order, 1, ties)


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    mark: str | None = None,
    chunk: str | None = None,
    ties: Sequence[OrderKey] | None = None,
) -> DataFrame:
    """Reduce an incoming batch to the last row per key: later chunk, then higher mark.
    A NULL mark counts as the highest, an open version being the current one."""
    order = [By(c) for c in (chunk, mark) if c]
    return latest_per_key(df, keys, order, ties)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row and surplus counts."""
    names = [require(df, k) for k in keys]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1).withColumn("surplus", F.col("row_count") - 1)


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys, repeated keys, and rows that a reduction to one per key drops."""
    names = [require(df, k) for k in keys]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("__n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness: repeated, or with a NULL part."""
    names = [require(df, k) for k in keys]
    has_null: Column = F.lit(False)
    for name in names:
        has_null = has_null | F.col(name).isNull()
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"))
    reason = F.when(has_null, F.lit("null_key")).when(F.col("row_count") > 1, F.lit("repeated_key"))
    return counted.withColumn("reason", reason).where(F.col("reason").isNotNull())


def ensure_unique(
    df: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "fail",
    order: Sequence[OrderKey] = (),
    ties: Sequence[OrderKey] | None = None,
) -> DataFrame:
    """``df`` with unique keys. ``fail`` counts keys now and raises on the first repeated
    or NULL one; ``dedupe`` keeps the first row per key in ``order``."""
    if on_duplicate == "dedupe":
        return latest_per_key(df, keys, order, ties)
    if on_duplicate != "fail":
        raise ValueError("on_duplicate is 'fail' or 'dedupe'")
    broken = key_violations(df, keys).limit(1).first()
    if broken is not None:
        raise ValueError(f"{broken['reason']} in ({', '.join(keys)}), {broken['row_count']} rows")
    return df
