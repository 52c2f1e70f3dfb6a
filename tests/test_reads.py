"""Filters, projections, deduplication and the extract plan."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.ordering import By
from pitsync.operators.dedupe import (
    duplicate_keys,
    duplicate_report,
    ensure_unique,
    keep_last,
    key_violations,
    latest_n_per_key,
    latest_per_key,
)
from pitsync.operators.filters import apply_filters, compose, semi_filter, since
from pitsync.operators.project import (
    add_missing_keys,
    align_to,
    derive,
    merge_schema,
    normalise,
    stamp,
    unpack_json,
)
from pitsync.plans.extract import plan_extract
from pitsync.spec import Snapshot, TableSpec, load_specs, spec_from_dict
from tests.conftest import plan_of, rows


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(i, i % 3, i % 2 == 0) for i in range(12)], "n int, m int, even boolean")


def ids(df):
    return sorted(r["n"] for r in df.collect())


def test_filters_compose(numbers):
    assert ids(apply_filters(numbers, None)) == list(range(12))
    assert ids(apply_filters(numbers, ["", "  "])) == list(range(12))
    assert ids(apply_filters(numbers, "WHERE n > 8")) == [9, 10, 11]
    assert ids(apply_filters(numbers, ["n > 8", "AND even"])) == [10]
    assert ids(apply_filters(numbers, ["even", F.col("n") < 4])) == [0, 2]


def test_or_items_follow_sql_precedence_and_marks_bind_to_all(numbers):
    filters = ["n = 1", "OR n > 6", "even"]
    assert ids(apply_filters(numbers, filters)) == [1, 8, 10]
    assert ids(since(apply_filters(numbers, filters), "n", 8)) == [10]


def test_items_are_parenthesised_and_or_names_are_not_connectors(spark, numbers):
    assert ids(apply_filters(numbers, ["n = 1 OR n = 2", "m = 2"])) == [2]
    df = spark.createDataFrame([(1,), (9,)], "order_id int")
    assert apply_filters(df, ["order_id > 0", "ORDER_ID > 5"]).count() == 1


def test_other_filter_types_warn(numbers):
    with pytest.warns(UserWarning):
        assert compose({"a": 1}) is None


def test_membership_does_not_repeat_rows(spark, numbers):
    members = spark.createDataFrame([(1,), (1,), (2,), (None,)], "MEMBER int")
    out = semi_filter(numbers, members, "N", "member")
    assert ids(out) == [1, 2]
    assert "LeftSemi" in plan_of(out)


def test_mark_is_strict_and_pushed_down(spark, folder):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3)], "ts timestamp_ntz")
    df.write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    out = since(stored, "TS", "2024-01-02")
    assert rows(out) == [(dt.datetime(2024, 1, 3),)]
    assert "GreaterThan(ts,2024-01-02" in plan_of(out)
    assert since(stored, "ts", None).count() == 3
    assert since(stored, "ts", "2024-01-02", full_reload=True).count() == 3
    mark = stored.agg(F.min("ts").alias("m"))
    assert since(stored, "ts", mark).count() == 2
    assert since(stored, "ts", mark.where("m IS NULL")).count() == 3


def test_point_mark_adds_rows_of_new_points(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (2, dt.date(2024, 1, 1), dt.date(2024, 2, 29))],
        "n int, f date, point date",
    )
    assert ids(since(df, "f", "2024-01-15")) == []
    assert ids(since(df, "f", "2024-01-15", point="point", point_mark="2024-01-31")) == [2]


def test_json_paths_types_and_strictness(spark):
    df = spark.createDataFrame(
        [(1, '{"a": "7", "A": 8, "d": "2024-01-31"}'), (2, '{"a": "x"}'), (3, "not json"), (4, None)], "n int, j string"
    )
    fields = {"a": ("a", "int"), "A": ("upper_a", "int"), "$.d": ("d", "date"), "zz": ("zz", "double")}
    got = rows(unpack_json(df, "j", fields, keep=["n"]), "n")
    assert got == [
        (7, 8, dt.date(2024, 1, 31), None, 1),
        (None, None, None, None, 2),
        (None, None, None, None, 3),
        (None, None, None, None, 4),
    ]
    with pytest.raises(Exception, match="(?i)cast|malformed|invalid"):
        unpack_json(df, "j", fields, strict=True).collect()
    variant = df.where("n = 1").selectExpr("parse_json(j) AS v")
    assert rows(unpack_json(variant, "v", [("a", "x", "int"), ("a", "y", "string")])) == [(7, "7")]


def test_normalise_stamp_align(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.5)], "ID int, Val double")
    assert rows(normalise(df), "id") == [(1, None), (2, 3.5)]
    assert not any(v is not None and math.isnan(v) for _, v in rows(normalise(df), "id"))
    stamped = stamp(df.select("ID"), "2024-02-01")
    again = stamp(stamped, "2030-01-01")
    assert {r["data_inserted_at"] for r in again.collect()} == {dt.datetime(2024, 2, 1)}
    target = T.StructType.fromDDL("val float, extra string, id bigint")
    assert rows(align_to(df.where("ID = 2"), target)) == [(3.5, None, 2)]


def test_schemas_merge_by_name_and_widen(spark):
    merged = merge_schema(
        T.StructType.fromDDL("id int, f float, s string, keep bigint"),
        T.StructType.fromDDL("ID bigint, F double, s int, new date, keep smallint"),
    )
    assert merged.simpleString() == "struct<id:bigint,f:double,s:string,keep:bigint,new:date>"


def test_missing_keys_are_added(spark):
    df = spark.createDataFrame([(1,)], "A int")
    assert add_missing_keys(df, {"a": "int", "d": "date"}).dtypes == [("A", "int"), ("d", "date")]
    assert derive(df, {"b": "A + 1"}).first()["b"] == 2


def test_latest_puts_open_versions_first_and_groups_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, None, "open"), (2, 1, "b"), (None, 1, "n1"), (None, 2, "n2")], "k int, o int, v string"
    )
    assert {r["v"] for r in latest_per_key(df, ["K"], ["o"]).collect()} == {"open", "b", "n2"}
    closed = latest_per_key(df, ["k"], [By("o", nulls_first=False)])
    assert {r["v"] for r in closed.collect()} == {"a", "b", "n2"}
    assert {r["v"] for r in keep_last(df, ["k"], "o").collect()} == {"open", "b", "n2"}


def test_latest_is_repeatable_on_ties(spark):
    df = spark.createDataFrame([(1, 1, f"v{i}") for i in range(50)], "k int, o int, v string")
    first = latest_per_key(df, ["k"], ["o"]).first()["v"]
    for parts in (1, 3, 7):
        assert latest_per_key(df.repartition(parts), ["k"], ["o"]).first()["v"] == first


def test_latest_n_ranks_and_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id < 400, 0, id % 10) AS k", "id AS o")
    out = latest_n_per_key(df, ["k"], ["o"], 3, rank_column="r")
    assert [(r["o"], r["r"]) for r in out.where("k = 5").orderBy("r").collect()] == [(995, 1), (985, 2), (975, 3)]
    plan = plan_of(out)
    assert plan.index("Partial") and "WindowGroupLimit" in plan


def test_duplicate_reports(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(df, ["k"]), "k") == [(None, 2, 1), (1, 3, 2)]
    assert rows(duplicate_report(df, ["K"])) == [(3, 2, 3)]
    assert {r["reason"] for r in key_violations(df, ["k"]).collect()} == {"null_key", "repeated_key"}
    assert duplicate_report(df.limit(0), ["k"]).first()["surplus_rows"] == 0


def orders_spec(**changes):
    spec = TableSpec(
        "t", "src", sync_mode="upsert", merge_keys=("k",), order_by="o", watermark="o", filters=("v <> 'drop'",)
    )
    return spec.with_(**changes)


def test_phases_differ(spark):
    src = spark.createDataFrame([(1, 1, "keep"), (1, 2, "drop"), (2, 1, "keep")], "k int, o int, v string")
    first = plan_extract(spark, orders_spec(), {"src": src})
    assert rows(first, "k") == [(1, 1, "keep"), (2, 1, "keep")]
    last = plan_extract(spark, orders_spec(), {"src": src}, phase="dedup_then_filter")
    assert rows(last, "k") == [(2, 1, "keep")]


def test_source_query_with_holes_and_deduplicated_source(spark):
    src = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, o int, v string")
    other = spark.createDataFrame([(1, "one")], "k int, name string")
    spec = orders_spec(
        source_query="SELECT t.*, o.name FROM {table} t JOIN {other} o ON t.k = o.k", source_is_deduplicated=True
    )
    out = plan_extract(spark, spec, {"src": src, "other": other})
    assert spec.phase == "dedup_then_filter"
    assert rows(out, "o") == [(1, 1, "a", "one"), (1, 2, "b", "one")]


@pytest.mark.parametrize("kind", ["asof", "valid"])
def test_increments_equal_the_filtered_snapshot(spark, kind):
    """Neither reading only ids with news nor splitting at the last point changes a row."""
    src = spark.range(400).selectExpr(
        "IF(id % 3 = 0, 0, IF(id % 11 = 0, NULL, id % 17)) AS k",
        "date_add(date'2024-01-01', CAST(id * 7 % 120 AS INT)) AS d",
        "date_add(date'2024-01-01', CAST(id * 7 % 120 + id % 50 AS INT)) AS e",
        "date_add(date'2023-12-01', CAST(id * 13 % 150 AS INT)) AS f",
        "id AS n",
    )
    snap = Snapshot(kind, "spine", "p", ("k",), "p", start="d", end="e", date="d", ties=("n",))
    spec = TableSpec("t", "src", sync_mode="upsert", merge_keys=("k", "p"), watermark="f", order_by="n", snapshot=snap)
    spine = spark.createDataFrame([(dt.date(2024, m, 28),) for m in (1, 2, 3, 4, 5)], "p date")
    tables = {"src": src, "spine": spine}
    whole = plan_extract(spark, spec, tables)

    def key(df):
        return sorted(map(str, df.select("k", "p", "n").collect()))

    assert len(key(whole)) > 20
    for mark in ("2024-01-15", "2024-04-10", "2030-01-01"):
        got = plan_extract(spark, spec, tables, mark=mark)
        assert key(got) == key(whole.where(f"f > date'{mark}'"))
        got = plan_extract(spark, spec, tables, mark=mark, point_mark="2024-03-28")
        assert key(got) == key(whole.where(f"f > date'{mark}' OR p > date'2024-03-28'"))


def test_ensure_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(ValueError, match="repeated_key"):
        ensure_unique(df, ["k"])
    assert ensure_unique(df.where("k = 2"), ["k"]).count() == 1
    assert rows(ensure_unique(df, ["k"], "dedupe", ["v"]), "k") == [(1, "b"), (2, "c")]


def test_mark_applies_only_to_incremental_modes(spark):
    src = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, o int, v string")
    assert plan_extract(spark, orders_spec(), {"src": src}, mark=1).count() == 1
    assert plan_extract(spark, orders_spec(sync_mode="full"), {"src": src}, mark=1).count() == 2
    assert plan_extract(spark, orders_spec(), {"src": src}, mark=1, full_reload=True).count() == 2


def test_specs(tmp_path):
    with pytest.raises(ValueError):
        TableSpec("t", "t", sync_mode="upsert")
    with pytest.raises(ValueError):
        TableSpec("t", "t", sync_mode="merge")
    with pytest.raises(ValueError):
        Snapshot("valid", "s", "c", ("id",), "p", start="f")
    assert orders_spec(merge_keys=("K", "O")).sort_keys == ("K", "O")
    assert orders_spec().sort_keys == ("k", "o")
    path = tmp_path / "tables.json"
    path.write_text(
        '{"defaults": {"sync_mode": "upsert", "watermark": "_from"}, "tables": [{"name": "a", "merge_keys": ["_id", "month_end"],'
        ' "members": {"table": "peers", "column": "id", "on": "_id"}, "filters": "x > 1",'
        ' "snapshot": {"kind": "asof", "spine_table": "s", "spine_column": "m", "id": "_id", "point": "month_end", "date": "d"},'
        ' "unpack": {"column": "j", "fields": {"a": ["a", "int"]}}}]}'
    )
    spec = load_specs(str(path))[0]
    assert spec.snapshot.id == ("_id",) and spec.members.on == "_id" and spec.unpack.fields["a"] == ("a", "int")
    assert spec.source == "a" and spec.filters == ("x > 1",)
    assert spec_from_dict({"name": "b"}).sync_mode == "full"
