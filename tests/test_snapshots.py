from __future__ import annotations

import datetime as dt
import random

import pytest
from pitsync.functions.ordering import By
from pitsync.operators.snapshots import distinct_points, month_ends, snapshot_asof, snapshot_valid
from tests.conftest import plan_of, rows

D = dt.date
T = dt.datetime


def spine(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "point date")


JAN, FEB, MAR = D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 31)


def test_valid_is_open_at_start_and_closed_at_end(spark):
    df = spark.createDataFrame(
        [
            (1, T(2024, 1, 31), T(2024, 2, 29), "starts at jan, ends at feb"),
            (2, T(2024, 1, 30, 23, 59), T(2024, 1, 31), "covers jan only"),
            (3, T(2024, 1, 31, 0, 0, 1), T(2024, 2, 28, 23, 59), "covers none"),
            (4, T(2020, 1, 1), T(2030, 1, 1), "covers all"),
            (5, T(2024, 1, 1), None, "open"),
        ],
        "id int, f timestamp_ntz, t timestamp_ntz, note string",
    )
    out = snapshot_valid(df, spine(spark, JAN, FEB, MAR), ["id"], "f", "t")
    got = sorted((r["id"], r["point"]) for r in out.collect())
    assert got == [(1, FEB), (2, JAN), (4, JAN), (4, FEB), (4, MAR)]
    opened = snapshot_valid(df, spine(spark, JAN, FEB, MAR), ["id"], "f", "t", open_end=True)
    got = sorted((r["id"], r["point"]) for r in opened.collect() if r["id"] == 5)
    assert got == [(5, JAN), (5, FEB), (5, MAR)]


def test_valid_prefers_later_start_then_later_end(spark):
    df = spark.createDataFrame(
        [
            (1, T(2024, 1, 1), T(2024, 12, 31), "old"),
            (1, T(2024, 1, 5), T(2024, 2, 15), "short"),
            (1, T(2024, 1, 5), T(2024, 2, 20), "long"),
        ],
        "id int, f timestamp_ntz, t timestamp_ntz, note string",
    )
    out = snapshot_valid(df, spine(spark, JAN, FEB), ["id"], "f", "t")
    assert sorted((r["point"], r["note"]) for r in out.collect()) == [(JAN, "long"), (FEB, "old")]


def test_asof_is_inclusive_and_carries_forward(spark):
    df = spark.createDataFrame(
        [
            (1, T(2024, 1, 31), "on jan"),
            (1, T(2024, 1, 31, 0, 0, 1), "just after jan"),
            (2, T(2019, 5, 5), "long ago"),
            (3, T(2024, 3, 31, 1), "after the last point"),
            (None, T(2024, 1, 1), "no id"),
            (4, None, "no date"),
        ],
        "id int, d timestamp_ntz, note string",
    )
    out = snapshot_asof(df, spine(spark, JAN, FEB, MAR, JAN), ["id"], "d")
    got = sorted(((r["id"], r["point"], r["note"]) for r in out.collect()), key=lambda r: (r[0] or 0, r[1]))
    assert got == [
        (None, JAN, "no id"),
        (None, FEB, "no id"),
        (None, MAR, "no id"),
        (1, JAN, "on jan"),
        (1, FEB, "just after jan"),
        (1, MAR, "just after jan"),
        (2, JAN, "long ago"),
        (2, FEB, "long ago"),
        (2, MAR, "long ago"),
    ]


def test_asof_ranks_equal_dates_by_order(spark):
    df = spark.createDataFrame([(1, JAN, 3, "b"), (1, JAN, None, "open"), (1, JAN, 9, "c")], "id int, d date, o int, note string")
    out = snapshot_asof(df, spine(spark, JAN), ["id"], "d", order=[By("o")])
    assert [r["note"] for r in out.collect()] == ["open"]
    last = snapshot_asof(df, spine(spark, JAN), ["id"], "d", order=[By("o", nulls_first=False)])
    assert [r["note"] for r in last.collect()] == ["c"]


def test_empty_spine_and_empty_table(spark):
    df = spark.createDataFrame([(1, JAN)], "id int, d date")
    assert snapshot_asof(df, spine(spark), ["id"], "d").count() == 0
    assert snapshot_asof(df.limit(0), spine(spark, JAN), ["id"], "d").count() == 0
    versions = spark.createDataFrame([(1, JAN, MAR)], "id int, f date, t date")
    assert snapshot_valid(versions, spine(spark), ["id"], "f", "t").count() == 0


def test_spine_must_be_dates(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1))], "id int, d timestamp_ntz")
    with pytest.raises(ValueError, match="must be a date"):
        snapshot_asof(df, df.select("d"), ["id"], "d")


def test_spine_ignores_nulls_and_repeats(spark):
    df = spark.createDataFrame([(T(2024, 2, 3, 4),), (T(2024, 2, 9),), (None,)], "d timestamp_ntz")
    assert rows(month_ends(df, "D")) == [(FEB,)]
    assert rows(distinct_points(df, "d", "day")) == [(D(2024, 2, 3),), (D(2024, 2, 9),)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_both_agree_with_brute_force(spark, seed):
    rnd = random.Random(seed)
    day0 = T(2024, 1, 1)
    points = sorted({(day0 + dt.timedelta(days=rnd.randrange(90))).date() for _ in range(8)})
    data = []
    for i in range(300):
        start = day0 + dt.timedelta(hours=rnd.randrange(100 * 24))
        # a third of all rows belong to one id
        ident = 0 if rnd.random() < 0.34 else rnd.randrange(1, 20)
        data.append((ident, start, start + dt.timedelta(hours=rnd.randrange(0, 30 * 24)), i))
    df = spark.createDataFrame(data, "id int, f timestamp_ntz, t timestamp_ntz, n int")
    line = spine(spark, *points)
    ids = {r[0] for r in data}

    want_asof, want_valid = set(), set()
    for p in points:
        at = T(p.year, p.month, p.day)
        for ident in ids:
            mine = [r for r in data if r[0] == ident]
            past = [r for r in mine if r[1] <= at]
            if past:
                want_asof.add((ident, p, max(past, key=lambda r: (r[1], r[3]))[3]))
            valid = [r for r in mine if r[1] < at <= r[2]]
            if valid:
                want_valid.add((ident, p, max(valid, key=lambda r: (r[1], r[2], r[3]))[3]))
    asof = snapshot_asof(df, line, ["id"], "f", ties=[By("n")])
    assert {(r["id"], r["point"], r["n"]) for r in asof.collect()} == want_asof
    for overlapping in (True, False):
        valid = snapshot_valid(df, line, ["id"], "f", "t", ties=[By("n")], overlapping=overlapping)
        assert {(r["id"], r["point"], r["n"]) for r in valid.collect()} == want_valid


def test_plans_have_no_join_with_the_spine(spark):
    df = spark.range(10).selectExpr("id", "date'2024-01-05' AS d", "date'2024-02-05' AS e")
    line = spine(spark, JAN, FEB)
    for plan in (
        plan_of(snapshot_asof(df, line, ["id"], "d")),
        plan_of(snapshot_valid(df, line, ["id"], "d", "e")),
    ):
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "EvalPython" not in plan
        assert "WindowGroupLimit" in plan


def test_hot_id_shrinks_before_the_window_over_ids(spark):
    """One id with a third of the rows reaches the per-id window as one row per point."""
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS id", "date_add(date'2024-01-01', CAST(id % 60 AS INT)) AS d", "id AS n"
    )
    out = snapshot_asof(df, spine(spark, JAN, FEB), ["id"], "d", ties=[By("n")])
    out.collect()
    graph = out._jdf.queryExecution().executedPlan().toString()
    assert graph.index("lead(") < graph.index("WindowGroupLimit")
    assert out.where("id = 0").count() == 2


def test_overlapping_versions_shrink_before_they_multiply(spark):
    df = spark.range(20_000).selectExpr("IF(id % 3 = 0, 0, id) AS id", "date'2024-01-05' AS f", "date'2024-12-31' AS t", "id AS n")
    out = snapshot_valid(df, spine(spark, JAN, FEB, MAR), ["id"], "f", "t", ties=[By("n")])
    apart = snapshot_valid(df, spine(spark, JAN, FEB, MAR), ["id"], "f", "t", ties=[By("n")], overlapping=False)
    assert plan_of(out).count("WindowGroupLimit") > plan_of(apart).count("WindowGroupLimit")
    assert sorted((r["point"], r["n"]) for r in out.where("id = 0").collect()) == [(JAN, 19_998), (FEB, 19_998), (MAR, 19_998)]
