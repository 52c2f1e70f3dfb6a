"""Quality rules, advice, catalogs, diffs, change detection and reports."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.hashing import row_hash
from pitsync.functions.types import is_widening, spark_type, target_type
from pitsync.operators.advice import advise_types, apply_types, dictionary_columns, reduction
from pitsync.operators.audit import delivery_listing, new_mark, purpose_parts, run_purpose, size_estimate
from pitsync.operators.catalog import (
    catalog,
    change_log_rows,
    classify,
    constraint_columns,
    evolve_actions,
    evolve_decision,
    first_extraction_rows,
    history_between,
    history_summary,
    latest_entries,
    observe_catalog,
    primary_key_columns,
    property_diff,
    same_key,
    schema_diff,
    structure_differences,
    summarise_changes,
)
from pitsync.operators.changes import (
    change_statistics,
    diff_hashes,
    diff_rows,
    hash_groups,
    hash_rows,
    id_collisions,
    rows_to_write,
)
from pitsync.operators.quality import check_columns, failed, match_counts, validate
from tests.conftest import plan_of, rows


def findings(df):
    return {(r["column"], r["check"]): (r["passed"], r["detail"]) for r in df.collect()}


# ---- quality ----------------------------------------------------------------------------


def test_rules(spark):
    df = spark.createDataFrame([(1, 5.0, dt.date(2000, 1, 1)), (None, 10.0, dt.date(1999, 1, 1))], "Id int, v double, d date")
    rules = {
        "ID": {"not_null": True, "null_rate_max": 0.5},
        "v": {"min_value": 10, "not_null": True},
        "d": {"min_value": "2000-01-01"},
        "gone": {"not_null": True, "min_value": 1},
    }
    assert findings(validate(df, rules)) == {
        ("ID", "not_null"): (False, "1 null(s)"),
        ("ID", "null_rate_max"): (True, "null_rate=0.5000 (max 0.5)"),
        ("v", "not_null"): (True, "OK"),
        ("v", "min_value"): (False, "min=5.0 (expected >= 10)"),
        ("d", "min_value"): (False, "min=1999-01-01 (expected >= 2000-01-01)"),
        ("gone", "column_exists"): (False, "Column gone not found in DataFrame"),
    }
    assert failed(validate(df, rules)).count() == 4
    assert findings(validate(df, {"v": {"min_value": 10}}, compat_string=True))[("v", "min_value")][0] is True
    assert validate(df, {}).count() == 0
    assert validate(df, {"v": {"not_null": False}}).count() == 0


def test_rules_on_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert findings(validate(df, {"v": {"min_value": 1}}))[("v", "min_value")] == (True, "no non-null values")
    empty = findings(validate(df.limit(0), {"v": {"null_rate_max": 0.0, "not_null": True}}))
    assert empty[("v", "null_rate_max")] == (True, "no rows") and empty[("v", "not_null")][0] is True


def test_all_rules_take_one_pass(spark, folder):
    spark.range(5).selectExpr("id", "id AS b").write.parquet(f"{folder}/t")
    plan = plan_of(validate(spark.read.parquet(f"{folder}/t"), {"id": {"not_null": True, "min_value": 0}, "b": {"null_rate_max": 0.1}}))
    assert plan.count("Location: InMemoryFileIndex") == 1


def test_requested_columns(spark):
    wanted = spark.createDataFrame([("t", "A"), ("t", "b"), ("t", "b"), ("t", "zz")], "table_name string, column_name string")
    known = spark.createDataFrame([("T", "a"), ("T", "B")], "table_name string, column_name string")
    got = {(r["column_name"], r["severity"]) for r in check_columns(wanted, known).collect()}
    assert got == {("zz", "error"), ("b", "warning")}


def test_match_counts(spark):
    have = spark.createDataFrame([("a", 3)], "t string, n bigint")
    want = spark.createDataFrame([("a", 3), ("b", 1)], "t string, m bigint")
    assert rows(match_counts(have, want, "t", "n", "m"), "t") == [("a", 3, 3, True), ("b", 1, 0, False)]


# ---- types ------------------------------------------------------------------------------


def test_target_types(spark):
    cases = [
        ("NUMBER", None, 4, 0, "SMALLINT"),
        ("number", None, 9, 0, "INTEGER"),
        ("DECIMAL", None, 18, 0, "BIGINT"),
        ("NUMERIC", None, 19, 0, "NUMERIC"),
        ("NUMBER", None, None, 0, "NUMERIC"),
        ("NUMBER", None, 12, 2, "NUMERIC(12,2)"),
        ("NUMBER", None, None, 2, "NUMERIC"),
        ("VARCHAR", 50, None, None, "VARCHAR(50)"),
        ("VARCHAR", 10_485_760, None, None, "VARCHAR(10485760)"),
        ("VARCHAR", 10_485_761, None, None, "TEXT"),
        ("VARCHAR", None, None, None, "TEXT"),
        ("CHAR", None, None, None, "CHAR(1)"),
        ("CHARACTER", 3, None, None, "CHAR(3)"),
        ("FLOAT", None, None, None, "DOUBLE PRECISION"),
        ("FLOAT4", None, None, None, "REAL"),
        ("BYTEINT", None, None, None, "SMALLINT"),
        ("TIMESTAMP_TZ", None, None, None, "TIMESTAMP WITH TIME ZONE"),
        ("TIMESTAMP_NTZ", None, None, None, "TIMESTAMP"),
        ("VARIANT", None, None, None, "JSONB"),
        ("VARBINARY", None, None, None, "BYTEA"),
        ("GEOGRAPHY", None, None, None, "TEXT"),
    ]
    df = spark.createDataFrame(cases, "t string, n int, p int, s int, want string")
    got = df.withColumn("got", target_type(F.col("t"), F.col("n"), F.col("p"), F.col("s")))
    assert [(r["t"], r["got"]) for r in got.where("got <> want").collect()] == []


def test_spark_types():
    assert spark_type("NUMBER", 4, 0) == T.ShortType()
    assert spark_type("NUMBER", None, 0) == T.DecimalType(38, 0)
    assert spark_type("NUMBER", 12, 2) == T.DecimalType(12, 2)
    assert spark_type("NUMBER", None, 2) == T.DecimalType(38, 2)
    assert spark_type("TIMESTAMP_NTZ") == T.TimestampNTZType() and spark_type("TIMESTAMP_TZ") == T.TimestampType()
    assert spark_type("VARIANT") == T.VariantType() and spark_type("GEOMETRY") == T.StringType()
    assert spark_type("TIME") == T.StringType()


def test_widenings(spark):
    cases = [
        ("SMALLINT", "INTEGER", True), ("integer", "BIGINT", True), ("BIGINT", "NUMERIC", True), ("REAL", "DOUBLE PRECISION", True),
        ("BIGINT", "INTEGER", False), ("VARCHAR(5)", "VARCHAR(9)", True), ("VARCHAR(9)", "VARCHAR(5)", False), ("VARCHAR(5)", "VARCHAR(5)", True),
        ("VARCHAR(5)", "TEXT", True), ("TEXT", "VARCHAR(5)", False), ("VARCHAR", "VARCHAR(5)", False), (None, "TEXT", False),
        ("DOUBLE PRECISION", "REAL", False),
    ]
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    got = df.withColumn("got", is_widening(F.col("a"), F.col("b")))
    assert got.where("got <> want").count() == 0


def test_advice(spark):
    df = spark.range(300).selectExpr(
        "id", "CAST(id * 200 AS BIGINT) AS mid", "id * 100000000000 AS big", "CAST(5 AS SMALLINT) AS tiny", "CAST(id AS DOUBLE) AS f",
        "1e300 AS huge", "CAST(id % 3 AS STRING) AS low", "CAST(id AS STRING) AS high", "CAST(NULL AS BIGINT) AS nothing",
    )
    got = {r["column"]: (r["from_type"], r["to_type"], r["rule"]) for r in advise_types(df, aggressive=True).collect()}
    assert got == {
        "id": ("bigint", "smallint", "int_downcast"),
        "mid": ("bigint", "int", "int_downcast"),
        "tiny": ("smallint", "tinyint", "int_downcast"),
        "f": ("double", "float", "float_downcast"),
        "low": ("string", "category", "category"),
    }
    assert "f" not in {r["column"] for r in advise_types(df).collect()}
    approx = {r["column"] for r in advise_types(df, aggressive=True, exact=False).collect()}
    assert approx == set(got)
    narrowed = apply_types(df, [(c, t) for c, (_, t, _) in got.items()])
    assert narrowed.selectExpr("sum(id)", "max(low)").first() == df.selectExpr("sum(id)", "max(low)").first()
    assert dict(narrowed.dtypes)["mid"] == "int" and dict(narrowed.dtypes)["low"] == "string"


def test_threshold_is_strict_and_nulls_count_as_rows(spark):
    half = spark.createDataFrame([("a",), ("b",), ("a",), ("b",)], "s string")
    assert advise_types(half).count() == 0
    with_nulls = spark.createDataFrame([("a",), (None,), (None,)], "s string")
    assert advise_types(with_nulls).first()["metric"] == pytest.approx(1 / 3)
    assert advise_types(half.limit(0)).count() == 0


def test_dictionary_columns_and_reduction(spark):
    df = spark.range(10).selectExpr("id", "id > 5 AS flag", "CAST(id AS TINYINT) AS t", "'x' AS s", "uuid() AS u")
    assert {r["column"] for r in dictionary_columns(df).collect()} == {"flag", "t", "s"}
    est = reduction(df.select("id", "s"), advise_types(df.select("id", "s"))).first()
    assert (est["bytes_before"], est["bytes_after"], est["columns_changed"]) == (24, 5, 2)


# ---- catalogs and diffs -----------------------------------------------------------------


def test_catalog_of_query_output(spark):
    df = spark.sql("SELECT 1 AS a, CAST(2 AS DECIMAL(10,2)) AS b, 'x' AS c, current_timestamp() AS t, parse_json('1') AS v")
    got = [(r["column_name"], r["target_type"], r["position"], r["is_nullable"]) for r in catalog(spark, {"q": df}).orderBy("position").collect()]
    assert got == [
        ("a", "INTEGER", 1, False), ("b", "NUMERIC(10,2)", 2, True), ("c", "TEXT", 3, False),
        ("t", "TIMESTAMP WITH TIME ZONE", 4, False), ("v", "JSONB", 5, False),
    ]


def test_observed_catalog(spark):
    df = spark.createDataFrame([(12345, "abc", None), (-7, None, None)], "n int, s string, nothing string")
    got = {r["column_name"]: (r["data_type"], r["target_type"], r["is_nullable"]) for r in observe_catalog(df, "t").collect()}
    assert got == {
        "n": ("NUMBER", "INTEGER", False), "s": ("VARCHAR", "VARCHAR(3)", True), "nothing": ("TEXT", "TEXT", True),
    }


COLS = "table_name string, column_name string, target_type string, is_nullable boolean, position int"


@pytest.fixture
def diff(spark):
    old = spark.createDataFrame(
        [("T", "id", "INTEGER", False, 1), ("T", "name", "VARCHAR(5)", False, 2), ("T", "gone", "TEXT", True, 3), ("U", "x", "TEXT", True, 1)], COLS
    )
    new = spark.createDataFrame(
        [("t", "ID", "BIGINT", False, 1), ("t", "extra", "TEXT", True, 2), ("t", "Name", "VARCHAR(3)", True, 3), ("U", "x", "TEXT", True, 1)], COLS
    )
    return schema_diff(old, new)


def test_schema_diff(diff):
    got = {(r["column_name"], r["change"]): (r["old_value"], r["new_value"]) for r in diff.collect()}
    assert got == {
        ("ID", "column_type_changed"): ("INTEGER", "BIGINT"),
        ("Name", "column_type_changed"): ("VARCHAR(5)", "VARCHAR(3)"),
        ("Name", "column_nullable_changed"): ("false", "true"),
        ("Name", "column_position_changed"): ("2", "3"),
        ("extra", "column_added"): (None, "TEXT"),
        ("gone", "column_removed"): ("TEXT", None),
    }


def test_classification_and_decision(diff):
    marked = classify(diff)
    safe = {(r["column_name"], r["change"]) for r in marked.where("safe").collect()}
    assert safe == {("ID", "column_type_changed"), ("Name", "column_nullable_changed"), ("extra", "column_added")}
    verdict = {r["table_name"].lower(): r for r in evolve_decision(marked).collect()}
    blocked = [r for r in evolve_decision(marked).collect() if r["breaking_count"] > 0]
    assert blocked and all(r["status"] == "blocked" for r in blocked) and verdict
    forced = {(r["column_name"], r["change"]): r["action"] for r in evolve_actions(marked, force=True).collect()}
    assert forced[("gone", "column_removed")] == "ignored" and forced[("Name", "column_position_changed")] == "ignored"
    assert forced[("Name", "column_type_changed")] == "alter_type"
    only_ignored = evolve_decision(marked.where("change = 'column_removed'"), force=True).first()
    assert only_ignored["status"] == "no_changes"


def test_summary_texts(spark):
    changes = spark.createDataFrame(
        [("t", "column_added"), ("t", "column_added"), ("t", "column_type_changed"), ("t", "primary_key_changed"),
         ("t", "comment_changed"), ("t", "comment_changed"), ("t", "column_position_changed"), ("u", "column_nullable_changed")],
        "table_name string, change string",
    )
    got = dict(rows(summarise_changes(changes)))
    assert got["t"] == "2 columns added, 1 type changed, primary key changed, 2 other changes"
    assert got["u"] == "1 nullable constraint changed"


def test_property_diff(spark):
    schema = "table_name string, primary_key array<string>, foreign_keys array<string>, comment string, clustering_key array<string>"
    old = spark.createDataFrame([("T", ["a", "b"], ["x"], "old", ["c", "d"])], schema)
    new = spark.createDataFrame([("t", ["b", "a"], ["x", "y"], "new", ["d", "c"])], schema)
    assert {r["change"] for r in property_diff(old, new).collect()} == {"foreign_keys_changed", "comment_changed", "clustering_key_changed"}


def test_constraints(spark):
    columns = spark.createDataFrame([("t", "a", 1), ("t", "b", 2), ("t", "c", 3)], "table_name string, column_name string, position int")
    keys = spark.createDataFrame([("t", "uq_1", [3, 1])], "table_name string, constraint_name string, key array<int>")
    named = constraint_columns(keys, columns)
    assert named.first()["columns"] == ["c", "a"]
    assert named.select(same_key(F.col("columns"), ["A", "C"])).first()[0] is True
    assert named.select(same_key(F.col("columns"), ["a"])).first()[0] is False
    constraints = spark.createDataFrame([("pk", "t", "PRIMARY KEY"), ("uq", "t", "UNIQUE")], "constraint_name string, table_name string, constraint_type string")
    usage = spark.createDataFrame([("pk", "t", "b", 2), ("pk", "t", "a", 1), ("uq", "t", "c", 1)], "constraint_name string, table_name string, column_name string, ordinal_position int")
    assert [r["column_name"] for r in primary_key_columns(constraints, usage).collect()] == ["a", "b"]


def test_structure_and_log(spark, diff):
    source = spark.createDataFrame([("T", "A"), ("T", "B")], "table_name string, column_name string")
    target = spark.createDataFrame([("t", "a"), ("t", "data_inserted_at"), ("t", "z")], "table_name string, column_name string")
    assert {(r["column_name"], r["difference"]) for r in structure_differences(source, target).collect()} == {("b", "missing_in_target"), ("z", "only_in_target")}
    log = change_log_rows(diff, "2024-02-01")
    assert log.count() == 6 and log.where("change = 'column_added'").first()["details"] == '{"new_value":"TEXT"}'
    first = first_extraction_rows(source.unionAll(spark.createDataFrame([("N", "x")], source.schema)), spark.createDataFrame([("T",)], "table_name string"), "2024-02-01")
    assert [r["table_name"] for r in first.collect()] == ["N"]


def test_history(spark):
    log = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", "c"), ("a", "2024-01-31T00:00:00", "c"), ("a", "rubbish", "c"), ("b", "2024-02-01", "init")], "t string, at string, kind string"
    )
    assert history_between(log, "at", "2024-01-01", "2024-01-31").count() == 2
    assert [tuple(r) for r in history_summary(log, ["t"], F.col("kind") == "init").collect()] == [("a", 3, 0, 3), ("b", 0, 1, 1)]
    top = latest_entries(log, 1, [F.desc("t")])
    assert top.first()["t"] == "b" and "TakeOrderedAndProject" in plan_of(top)


# ---- change detection -------------------------------------------------------------------


def test_row_hash_tells_nulls_and_separators_apart(spark):
    df = spark.createDataFrame([("a|1:b", None), ("a", "b"), (None, "a|1:b"), ("", None), (None, ""), ("-", "-"), (None, None)], "x string, y string")
    assert df.select(row_hash(df.schema).alias("h")).distinct().count() == 7


def test_row_hash_takes_nested_and_binary_columns(spark):
    df = spark.sql("SELECT array(1.5F, 2.5F) AS e, named_struct('a', 1) AS s, map('k', 1) AS m, X'00FF' AS b, true AS t, DATE'2024-01-01' AS d")
    assert len(df.select(row_hash(df.schema).alias("h")).first()["h"]) == 64
    assert diff_rows(df, df, ["t"]).first()["status"] == "unchanged"


@pytest.mark.parametrize("seed", [1, 2])
def test_diff_covers_every_key_once(spark, seed):
    rnd = random.Random(seed)
    old = {k: rnd.randrange(3) for k in rnd.sample(range(50), 30)}
    new = {k: rnd.randrange(3) for k in rnd.sample(range(50), 30)}
    want = {}
    for k in old.keys() | new.keys():
        want[k] = "deleted" if k not in new else "new" if k not in old else "unchanged" if old[k] == new[k] else "changed"
    o = spark.createDataFrame(list(old.items()), "k int, v int")
    n = spark.createDataFrame(list(new.items()), "k int, v int")
    assert dict(rows(diff_hashes(hash_rows(o, ["k"]), hash_rows(n, ["k"]), ["k"]))) == want
    assert dict(rows(diff_rows(o, n, ["K"]))) == want
    stats = change_statistics(diff_rows(o, n, ["k"])).first()
    assert stats["new"] + stats["changed"] == stats["written"]
    assert stats["total"] == sum(v != "deleted" for v in want.values())


def test_diff_of_repeated_keys(spark):
    def t(*values):
        return spark.createDataFrame([(1, v) for v in values], "k int, v string")

    def status(a, b):
        return diff_rows(a, b, ["k"]).first()["status"]

    assert status(t("a", "b"), t("b", "a")) == "unchanged"
    assert status(t("a", "a"), t("b", "b")) == "changed"
    assert status(t("a", "b"), t("a")) == "changed"
    assert status(t("a", "a", "b"), t("a", "b", "b")) == "changed"


def test_an_old_copy_without_a_hash_is_unreadable(spark):
    old = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "k int, row_hash string")
    new = spark.createDataFrame([(1, "x"), (2, "a"), (4, None)], "k int, row_hash string")
    status = diff_hashes(old, new, ["k"])
    assert dict(rows(status)) == {1: "unreadable", 2: "unchanged", 3: "deleted", 4: "new"}
    assert sorted(r["k"] for r in rows_to_write(new, status, ["k"]).collect()) == [1, 4]
    assert change_statistics(status).first()["changed"] == 1


def test_diff_refuses_unequal_types(spark):
    with pytest.raises(ValueError, match="bigint"):
        diff_rows(spark.sql("SELECT 1 AS k, 1 AS v"), spark.sql("SELECT 1 AS k, 1L AS v"), ["k"])


def test_group_hash_ignores_order_and_sees_repeats(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v", "IF(id % 7 = 0, NULL, id) AS n")
    a = dict((r["g"], r["row_hash"]) for r in hash_groups(df, ["g"]).collect())
    b = dict((r["g"], r["row_hash"]) for r in hash_groups(df.orderBy(F.desc("v")).repartition(5), ["g"]).collect())
    c = dict((r["g"], r["row_hash"]) for r in hash_groups(df.unionAll(df.where("v = 1")), ["g"]).collect())
    d = dict((r["g"], r["row_hash"]) for r in hash_groups(df.withColumn("v", F.when(F.col("v") == 2, 3).otherwise(F.col("v"))), ["g"]).collect())
    assert a == b and a[0] == c[0] and a[1] != c[1] and a[2] != d[2] and a[1] == d[1]
    swapped = spark.createDataFrame([(None, 1)], "x int, y int"), spark.createDataFrame([(1, None)], "x int, y int")
    assert diff_rows(swapped[0].selectExpr("1 AS k", "*"), swapped[1].selectExpr("1 AS k", "*"), ["k"]).first()["status"] == "changed"


def test_collisions(spark):
    df = spark.createDataFrame([("i", 1), ("i", 1), ("j", 2), ("j", 3), (None, 4), (None, 5)], "id string, k int")
    assert rows(id_collisions(df, "id", "k")) == [("j", 2)]


# ---- reports ----------------------------------------------------------------------------


def test_mark_is_typed_and_falls_back(spark):
    df = spark.createDataFrame([("a", 9), ("a", 10), ("b", None)], "g string, n int")
    assert rows(new_mark(df, "n", ["g"], run_ts=77), "g") == [("a", 10, 2), ("b", 77, 1)]


def test_listing_and_purpose(spark):
    results = spark.createDataFrame(
        [("a", None, 5, 1, "f1"), ("b", "full", None, None, None), ("zz", None, 1, 1, None)],
        "table_name string, sync_mode string, total_rows bigint, total_chunks bigint, folder_id string",
    )
    specs = spark.createDataFrame([("a", "upsert", "k", "w", "x.a"), ("b", "upsert", "k", None, "x.b")], "name string, sync_mode string, merge_keys string, watermark_column string, target string")
    got = {r["name"]: (r["sync_mode"], r["total_rows"], r["data_folder"], r["target"]) for r in delivery_listing(results, specs).collect()}
    assert got == {"a": ("upsert", 5, "f1", "x.a"), "b": ("full", 0, "b", "x.b"), "zz": ("full", 1, "zz", None)}
    tables = spark.createDataFrame([("upsert", f"t{i}") for i in range(5)] + [("full", "c"), ("full", "a"), ("full", "b")], "sync_mode string, table_name string")
    assert run_purpose(tables).first()["purpose"] == "full: a, b, c; upsert: 5 tables"
    hot = spark.range(20_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS m", "CAST(id AS STRING) AS t")
    assert purpose_parts(hot, "m", "t").where("m = 'hot'").first()["purpose"] == "hot: 6667 tables"


def test_size_estimate(spark):
    df = spark.range(50)
    got = size_estimate(df, F.lit(1000), F.lit(100)).first()
    assert (got["row_count"], got["size_bytes"]) == (50, 500)
    assert size_estimate(df, F.lit(0), F.lit(0)).first()["size_bytes"] == 0
