"""Comparing file layouts by writing them, and by how many files a filter reaches."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitsync.operators.advice import advise_types, apply_types
from pitsync.sources.manifest import stored_bytes
from pitsync.sources.sinks import LayoutSpec, write_layout


def standard_layouts(sort_keys: tuple[str, ...] = ()) -> dict[str, tuple[LayoutSpec, bool]]:
    """The layouts worth comparing: name -> (layout, with narrowed types)."""
    light = LayoutSpec(sort_keys=sort_keys, level=3)
    heavy = LayoutSpec(sort_keys=sort_keys, level=15)
    return {
        "zstd_3": (light, False),
        "zstd_15": (heavy, False),
        "types": (light, True),
        "zstd_15_types": (heavy, True),
    }


def compare_layouts(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    layouts: Mapping[str, tuple[LayoutSpec, bool]],
) -> DataFrame:
    """Write each layout below ``root`` and report size, saving against the first, time,
    and which one is smallest and which fastest."""
    rows = []
    advice = None
    for position, (name, (layout, narrowed)) in enumerate(layouts.items()):
        frame = df
        if narrowed:
            if advice is None:  # at most one row per column
                advice = [(r["column"], r["to_type"]) for r in advise_types(df).toLocalIterator()]
            frame = apply_types(df, advice)
        began = time.monotonic()
        write_layout(frame, f"{root}/{name}", layout, mode="overwrite")
        seconds = time.monotonic() - began
        rows.append((position, name, stored_bytes(spark, f"{root}/{name}"), seconds))
    measured = spark.createDataFrame(rows, "position int, layout string, size_bytes long, seconds double")
    everything = Window.partitionBy()  # one row per layout
    first = F.first("size_bytes").over(Window.partitionBy().orderBy("position"))
    return measured.select(
        "layout",
        "size_bytes",
        F.round((first - F.col("size_bytes")) * 100.0 / first, 2).alias("saving_pct"),
        F.round("seconds", 3).alias("seconds"),
        (F.col("size_bytes") == F.min("size_bytes").over(everything)).alias("smallest"),
        (F.col("seconds") == F.min("seconds").over(everything)).alias("fastest"),
    )


def files_reached(stored: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """How far a filter low <= column < high reaches into stored files: files,
    files_reached, rows, rows_reached (of files that it cannot skip), rows_found.

    A file is skipped where its least and greatest value lie beyond the range, as
    a reader decides by footers. The bounds are taken from the rows by one aggregation
    per file.
    """
    value = F.col(f"`{column}`")
    inside = (value >= F.lit(low)) & (value < F.lit(high))
    by_file = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(value).alias("least"), F.max(value).alias("greatest"), F.count("*").alias("n"), F.count_if(inside).alias("found")
    )
    reached = (F.col("greatest") >= F.lit(low)) & (F.col("least") < F.lit(high))
    return by_file.agg(
        F.count("*").alias("files"),
        F.count_if(reached).alias("files_reached"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(reached, F.col("n"))), F.lit(0)).alias("rows_reached"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("rows_found"),
    )
