"""Distinct counts by hash and by united sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitsync.operators.advice import distinct_counts, distinct_shares
from pitsync.operators.sketches import category_columns, column_sketches, unite
from tests.conftest import plan_of, rows


def _frame(spark):
    return spark.range(20_000).selectExpr(
        "CAST(id AS STRING) AS all_differ", "CAST(id % 9 AS STRING) AS few", "IF(id % 2 = 0, CAST(id AS STRING), 'x') AS `at half`",
        "CAST(NULL AS STRING) AS none", "IF(id < 9000, CAST(id AS STRING), NULL) AS below", "id",
    )


def test_counts_by_hash_equal_counts_of_values(spark):
    df = _frame(spark)
    names = ["all_differ", "few", "at half", "none", "below"]
    want = df.agg(*[F.count_distinct(f"`{n}`") for n in names]).first()
    got = {r["column"]: r["distinct_count"] for r in distinct_counts(df, names).collect()}
    assert [got.get(n, 0) for n in names] == list(want)
    shares = {r["column"]: r["share"] for r in distinct_shares(df).collect()}
    assert shares == {n: want[k] / 20_000 for k, n in enumerate(names)}
    assert "Expand" not in plan_of(distinct_counts(df, names))
    assert {r["share"] for r in distinct_shares(df.limit(0)).collect()} == {None}


def test_united_sketches_come_close_and_close_calls_are_recounted(spark, folder):
    df = _frame(spark)
    column_sketches(df.where("id < 15000"), F.expr("CAST(id % 5 AS STRING)")).write.mode("append").parquet(folder)
    column_sketches(df.where("id >= 15000"), F.lit("late file")).write.mode("append").parquet(folder)
    kept = spark.read.parquet(folder)
    seen = {r["column"]: (r["rows"], r["estimate"]) for r in unite(kept).collect()}
    assert all(n == 20_000 for n, _ in seen.values())
    for name, true in (("all_differ", 20_000), ("few", 9), ("at half", 10_001), ("none", 0), ("below", 9000)):
        assert abs(seen[name][1] - true) <= 0.05 * true
    got = rows(category_columns(kept, df), "column")
    assert got == [("all_differ", False, False), ("at half", False, True), ("below", True, False), ("few", True, False), ("none", True, False)]
