"""Layouts along a space-filling curve."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pitsync.functions.curve import interleave, with_curve_key
from pitsync.sources.layouts import files_reached
from pitsync.sources.sinks import LayoutSpec, arrange, write_layout
from tests.conftest import plan_of, rows


def test_bits_of_ranks_alternate(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    got = {(r["a"], r["b"]): r["z"] for r in df.select("a", "b", interleave([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    want = {(a, b): int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}", strict=True)), 2) for a, b in got}
    assert got == want and sorted(got.values()) == list(range(64))


def test_every_type_has_a_rank_that_grows_with_it(spark):
    df = spark.range(2000).selectExpr(
        "id", "id * 2.5D AS d", "CAST(id AS DECIMAL(30, 2)) AS `a dec`", "date_add(DATE '1960-01-01', CAST(id AS INT) * 20) AS day",
        "timestamp_micros(id * 1000000000) AS ts", "lpad(CAST(id AS STRING), 5, '0') AS s", "id > 1000 AS b", "encode(lpad(CAST(id AS STRING), 5, '0'), 'UTF-8') AS bin",
    ).withColumn("ntz", F.col("ts").cast("timestamp_ntz"))
    for column in df.columns:
        keys = [r["k"] for r in with_curve_key(df, [column], "k").orderBy("id").collect()]
        assert keys == sorted(keys) and keys[0] >= 0
        assert len(set(keys)) == 2 if column == "b" else len(set(keys)) > 500
    with pytest.raises(ValueError, match="no place"):
        with_curve_key(df.select(F.array("id").alias("a")), ["a"], "k")


def test_nulls_ties_repeated_rows_and_clashing_names(spark, folder):
    values = [(None, float("nan"), 1), (1, None, 2), (1, float("inf"), 3), (1, float("-inf"), 4), (1, 0.5, 5), (1, 0.5, 5), (None, None, 6)]
    df = spark.createDataFrame(values, "a int, x double, curve_key int")
    write_layout(df, folder + "/t", LayoutSpec(sort_keys=("A", "x", "missing"), clustering="curve"))
    back = spark.read.parquet(folder + "/t")
    assert back.columns == df.columns and rows(back, "curve_key").__repr__() == rows(df, "curve_key").__repr__()
    keys = {r["curve_key"]: r["k"] for r in with_curve_key(df, ["a"], "k").collect()}
    assert keys[1] == keys[6] > keys[2]
    none = df.limit(0)
    write_layout(none, folder + "/none", LayoutSpec(sort_keys=("a", "x"), clustering="curve"))
    assert spark.read.schema(df.schema).parquet(folder + "/none").count() == 0
    nulls = df.select(F.lit(None).cast("int").alias("a"))
    assert arrange(nulls, LayoutSpec(sort_keys=("a",), clustering="curve")).count() == 7


def test_filters_on_both_columns_reach_few_files(spark, folder):
    """A third of the rows has one value of ``k``; the curve splits it by the date."""
    df = spark.range(64_000).selectExpr(
        "IF(id % 3 = 0, 7, xxhash64(id) % 100000) AS k", "timestamp_seconds(pmod(xxhash64(id, 1), 100000000)) AS ts", "id"
    )
    reach = {}
    for name in ("range", "curve"):
        write_layout(df, f"{folder}/{name}", LayoutSpec(sort_keys=("k", "ts"), clustering=name, max_records=1000))
        stored = spark.read.parquet(f"{folder}/{name}")
        for column, low, high in (("k", 50_000, 60_000), ("ts", datetime(1970, 1, 1), datetime(1970, 5, 1))):
            r = files_reached(stored, column, low, high).first()
            assert r["rows"] == 64_000 and r["rows_found"] == df.where((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))).count()
            reach[name, column] = r["files_reached"] / r["files"]
    assert reach["range", "k"] < 0.2 and reach["range", "ts"] > 0.6
    assert reach["curve", "k"] < 0.35 and reach["curve", "ts"] < 0.35


def test_key_is_computed_without_python(spark):
    plan = plan_of(arrange(spark.range(100).selectExpr("id", "id % 7 AS x"), LayoutSpec(sort_keys=("id", "x"), clustering="curve")))
    assert "Python" not in plan and "rangepartitioning" in plan
