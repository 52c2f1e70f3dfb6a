"""Data-quality rules: all checks of a table in one aggregation pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.names import find

FINDING = "column string, check string, passed boolean, detail string"


def _finding(column: str, check: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(check).alias("check"),
        passed.alias("passed"),
        detail.alias("detail"),
    )


def validate(df: DataFrame, rules: Mapping[str, Mapping[str, Any]], compat_string: bool = False) -> DataFrame:
    """One finding per rule: ``column, check, passed, detail``.

    Rules per column: ``not_null``, ``null_rate_max``, ``min_value``. Names match without
    regard to case; an unknown column is a failed ``column_exists`` finding and its other
    rules are skipped. ``min_value`` compares as the column's type; ``compat_string``
    compares texts. Empty tables and all-NULL columns pass, and say so.
    """
    aggregates: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    findings: list[Column] = []
    for i, (wanted, checks) in enumerate(rules.items()):
        name = find(df, wanted)
        if name is None:
            detail = F.lit(f"Column {wanted} not found in DataFrame")
            findings.append(_finding(wanted, "column_exists", F.lit(False), detail))
            continue
        col, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        nulls = F.col(f"__nulls_{i}")
        if checks.get("not_null") or "null_rate_max" in checks:
            blank = col.isNull()
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                blank = blank | F.isnan(col)
            aggregates.append(F.count_if(blank).alias(f"__nulls_{i}"))
        if checks.get("not_null"):
            detail = F.when(nulls == 0, F.lit("OK")).otherwise(F.format_string("%d null(s)", nulls))
            findings.append(_finding(wanted, "not_null", nulls == 0, detail))
        if "null_rate_max" in checks:
            limit = float(checks["null_rate_max"])
            empty = F.col("__rows") == 0
            rate = F.when(~empty, nulls / F.col("__rows"))
            findings.append(
                _finding(
                    wanted,
                    "null_rate_max",
                    F.coalesce(rate <= limit, F.lit(True)),
                    F.when(empty, F.lit("no rows")).otherwise(
                        F.concat(F.lit("null_rate="), F.format_string("%.4f", rate), F.lit(f" (max {limit})"))
                    ),
                )
            )
        if "min_value" in checks:
            bound = checks["min_value"]
            aggregates.append(F.min(col).alias(f"__min_{i}"))
            low = F.col(f"__min_{i}")
            if compat_string:
                passed = low.cast("string") >= F.lit(str(bound))
            else:
                passed = low >= F.lit(bound).cast(dtype)
            text = F.concat(F.lit("min="), low.cast("string"), F.lit(f" (expected >= {bound})"))
            findings.append(
                _finding(
                    wanted,
                    "min_value",
                    F.coalesce(passed, F.lit(True)),
                    F.coalesce(text, F.lit("no non-null values")),
                )
            )
    if not findings:
        return df.sparkSession.createDataFrame([], FINDING)
    return df.agg(*aggregates).select(F.explode(F.array(*findings)).alias("f")).select("f.*")


def failed(findings: DataFrame) -> DataFrame:
    return findings.where(~F.col("passed"))


def check_columns(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested ``(table_name, column_name)`` rows against a column catalog.

    Severity ``error`` for columns the table lacks, ``warning`` for columns requested
    more than once; nothing for the rest. Names match without regard to case.
    """
    wanted = requested.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("times"))
    known = catalog.select(
        F.upper("table_name").alias("__t"), F.upper("column_name").alias("__c")
    ).distinct().withColumn("__known", F.lit(True))
    joined = wanted.join(
        known,
        (F.upper("table_name") == F.col("__t")) & (F.upper("column_name") == F.col("__c")),
        "left",
    )
    severity = F.when(F.col("__known").isNull(), F.lit("error")).when(F.col("times") > 1, F.lit("warning"))
    return (
        joined.withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .select("table_name", "column_name", "times", "severity")
    )


def match_counts(actual: DataFrame, expected: DataFrame, on: str, actual_count: str, expected_count: str) -> DataFrame:
    """Row-count verification: expected against actual totals, one row per expectation."""
    have = actual.select(F.col(on).alias("__on"), F.col(actual_count).alias("actual_rows"))
    return (
        expected.join(have, F.col(on) == F.col("__on"), "left")
        .select(
            on,
            F.col(expected_count).alias("expected_rows"),
            F.coalesce("actual_rows", F.lit(0)).cast("long").alias("actual_rows"),
        )
        .withColumn("matches", F.col("expected_rows") == F.col("actual_rows"))
    )

