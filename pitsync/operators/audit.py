"""Run and delivery reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.operators.dedupe import latest_n_per_key
from pitsync.functions.ordering import By

NAMES_LISTED = 3


def new_mark(df: DataFrame, column: str, by: Sequence[str] = (), run_ts: Any = None) -> DataFrame:
    """Highest non-NULL mark, compared as its type; the run time where there is none."""
    dtype = df.schema[column].dataType
    high: Column = F.max(column)
    if run_ts is not None:
        high = F.coalesce(high, F.lit(run_ts).cast(dtype))
    return df.groupBy(*by).agg(high.alias("mark"), F.count(F.lit(1)).alias("rows_exported"))


def delivery_listing(results: DataFrame, specs: DataFrame) -> DataFrame:
    """Export results with what a consumer needs to load them.

    ``results``: table_name, sync_mode, total_rows, total_chunks, folder_id; ``specs``:
    name, sync_mode, merge_keys, watermark_column, target. The result's mode wins over
    the spec's; without either it is full.
    """
    s = specs.select(
        F.col("name").alias("__name"),
        F.col("sync_mode").alias("__mode"),
        F.col("merge_keys"),
        F.col("watermark_column"),
        F.col("target"),
    )
    joined = results.join(s, F.col("table_name") == F.col("__name"), "left")
    return joined.select(
        F.col("table_name").alias("name"),
        F.coalesce("sync_mode", "__mode", F.lit("full")).alias("sync_mode"),
        "merge_keys",
        "watermark_column",
        F.coalesce("total_rows", F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce("total_chunks", F.lit(0)).cast("long").alias("total_chunks"),
        F.coalesce("folder_id", "table_name").alias("data_folder"),
        "target",
    )


def purpose_parts(results: DataFrame, mode: str, table: str) -> DataFrame:
    """Text per mode: its table names if there are at most three, else their number.

    Only the first four names of a mode leave a task, whatever the size of the mode.
    """
    counted = results.groupBy(mode).agg(F.count(F.lit(1)).alias("tables"))
    order = [By(table, descending=False, nulls_first=False)]
    head = latest_n_per_key(results.select(mode, table), [mode], order, NAMES_LISTED + 1, ties=[])
    names = head.groupBy(mode).agg(F.array_sort(F.collect_list(table)).alias("names"))
    text = F.when(F.col("tables") <= NAMES_LISTED, F.concat_ws(", ", "names")).otherwise(
        F.concat(F.col("tables").cast("string"), F.lit(" tables"))
    )
    return counted.join(names, mode).select(
        mode, "tables", F.concat(F.col(mode).cast("string"), F.lit(": "), text).alias("purpose")
    )


def run_purpose(results: DataFrame, mode: str = "sync_mode", table: str = "table_name") -> DataFrame:
    """One sentence for a run; modes are the three sync modes, so the list is short."""
    parts = purpose_parts(results, mode, table)
    listed = F.array_sort(F.collect_list(F.struct(F.col(mode).alias("m"), F.col("purpose").alias("p"))))
    return parts.agg(F.concat_ws("; ", F.transform(listed, lambda x: x["p"])).alias("purpose"))


def run_summary(log: DataFrame, run: str, table: str, rows: str, error: Column | None = None) -> DataFrame:
    """Tables processed and failed and rows moved, per run; failed tables add no rows."""
    bad = F.lit(False) if error is None else F.coalesce(error, F.lit(False))
    per_table = log.groupBy(run, table).agg(
        F.max(bad.cast("int")).alias("__bad"), F.sum(F.when(~bad, F.col(rows))).alias("__rows")
    )
    return per_table.groupBy(run).agg(
        F.count_if(F.col("__bad") == 0).alias("tables_processed"),
        F.count_if(F.col("__bad") == 1).alias("tables_failed"),
        F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias("total_rows"),
    )


def size_estimate(filtered: DataFrame, total_bytes: Column, total_rows: Column) -> DataFrame:
    """Rows of a filtered plan times the average stored row size; zero without statistics."""
    counted = filtered.agg(F.count(F.lit(1)).alias("row_count"))
    average = F.when(total_rows > 0, total_bytes / total_rows).otherwise(F.lit(0.0))
    sized = counted.withColumn("size_bytes", F.floor(F.col("row_count") * average))
    return sized.withColumn("size_mb", F.round(F.col("size_bytes") / (1024 * 1024), 4))
