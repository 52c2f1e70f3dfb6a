"""Distinct counts from sketches that are kept by file and united."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.operators.advice import CATEGORY_RATIO, distinct_counts

SKETCHES = "file string, rows long, column string, sketch binary"
#: log2 of the buckets of a sketch; its relative error is about 1.04 / sqrt(2^13)
PRECISION = 13
#: how many standard errors around a threshold count as close
CLOSE = 5


def column_sketches(df: DataFrame, file: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(file, rows, column, sketch): one HyperLogLog sketch per file and text column.

    One pass without a shuffle of values: what travels is a sketch of at most 8 KB per task,
    file and column. ``file`` names the file, or whatever part of a table arrives at once.
    """
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    aggregates = [F.hll_sketch_agg(F.col(f"`{n}`"), PRECISION).alias(f"__s{k}") for k, n in enumerate(names)]
    wide = df.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"__s{k}").alias("sketch")) for k, n in enumerate(names)])
    return wide.select("file", "rows", F.explode(pairs).alias("p")).select("file", "rows", "p.column", "p.sketch")


def unite(sketches: DataFrame) -> DataFrame:
    """(column, rows, estimate) over the files of a table; no row is read."""
    united = sketches.groupBy("column").agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("s"))
    return united.select("column", "rows", F.hll_sketch_estimate("s").alias("estimate"))


def category_columns(sketches: DataFrame, df: DataFrame, threshold: float = CATEGORY_RATIO) -> DataFrame:
    """(column, is_category, recounted): whether the distinct share is below ``threshold``.

    Estimates decide where they are clear. A column whose estimated share is within
    ``CLOSE`` standard errors of the threshold is counted anew in ``df``, on hashes, so
    the answers are those of exact counts; a clear case is wrong by a chance below 10^-6.
    """
    margin = CLOSE * 1.04 / (2**PRECISION) ** 0.5 * threshold
    seen = unite(sketches).withColumn("share", F.col("estimate") / F.col("rows")).collect()  # one row per column
    near = [r["column"] for r in seen if abs(r["share"] - threshold) <= margin]
    spark = df.sparkSession
    clear = spark.createDataFrame([(r["column"], r["share"] < threshold, False) for r in seen if r["column"] not in near], "column string, is_category boolean, recounted boolean")
    if not near:
        return clear
    total = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    listed = spark.createDataFrame([(n,) for n in near], "column string")
    exact = listed.join(distinct_counts(df, near), "column", "left")
    return clear.unionByName(exact.select("column", (F.coalesce("distinct_count", F.lit(0)) / total < threshold).alias("is_category"), F.lit(True).alias("recounted")))
