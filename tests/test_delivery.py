from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitsync.plans.delivery import import_listing, listed_spec
from pitsync.plans.sync import Workspace, export_table, import_table
from pitsync.spec import TableSpec

NOW = dt.datetime(2024, 2, 1)
LISTING = "name string, sync_mode string, merge_keys array<string>, watermark_column string, total_rows long, total_chunks long, data_folder string, target string"


def listing(spark, *entries):
    return spark.createDataFrame([(n, m, k, None, 0, 0, n, to) for n, m, k, to in entries], LISTING)


@pytest.fixture
def ws(spark, folder):
    ws = Workspace(spark, folder)
    for name in ("a", "b"):
        table = spark.createDataFrame([(1, name), (2, name)], "k int, v string")
        export_table(ws, TableSpec(name, name), {name: table}, "r1", run_ts=NOW)
    return ws


def test_listed_tables_load_and_broken_entries_fail_alone(spark, ws):
    listed = listing(spark, ("b", "upsert", ["k"], "dw_b"), ("absent", "full", None, None), ("a", None, None, None), ("odd", "upsert", None, None))
    done = {r["table_name"]: r for r in import_listing(ws, listed, "r1", run_ts=NOW)}
    assert {k for k, r in done.items() if r["error"]} == {"absent", "odd"}
    assert done["a"]["rows"] == done["b"]["rows"] == 2 and done["b"]["sync_mode"] == "upsert"
    assert ws.target("dw_b").read().count() == 2 and ws.target("a").read().count() == 2
    assert ws.run_log().where("failed").count() == 2
    again = import_listing(ws, listed, "r1", only="B", run_ts=NOW)
    assert [(r["table_name"], r["rows"]) for r in again] == [("b", 0)]
    with pytest.raises(ValueError):
        import_listing(ws, listed, "r1", only="nope")


def test_a_table_listed_twice_is_an_error_and_no_table_is_none(spark, ws):
    with pytest.raises(ValueError):
        import_listing(ws, listing(spark, ("a", "full", None, None), ("A", "full", None, None)), "r1")
    assert import_listing(ws, listing(spark).limit(0), "r1") == []


def test_known_specs_fill_what_the_listing_does_not_say(spark, ws):
    known = TableSpec("b", "src", sync_mode="full", merge_keys=("k",), rules={"v": {"not_null": True}})
    spec = listed_spec(listing(spark, ("b", "upsert", None, None)).first(), known)
    assert (spec.source, spec.sync_mode, spec.merge_keys, spec.rules) == ("src", "upsert", ("k",), known.rules)
    text = spark.createDataFrame([("t", "upsert", "x, y")], "name string, sync_mode string, merge_keys string").first()
    assert listed_spec(text).merge_keys == ("x", "y")


@pytest.mark.parametrize("buckets", [0, 2])
def test_guard_refuses_what_breaks_readers(spark, folder, buckets):
    ws, first = Workspace(spark, folder), spark.createDataFrame([(1, 5, "a")], "k int, n long, v string")
    spec = TableSpec("t", "t", sync_mode="upsert", merge_keys=("k",), buckets=buckets)

    def load(df, run, guard=True):
        export_table(ws, spec, {"t": df}, run, run_ts=NOW)
        return import_table(ws, spec, run, run_ts=NOW, guard_schema=guard)

    assert load(first, "r1")["rows"] == 1
    with pytest.raises(ValueError, match="v column_removed"):
        load(first.drop("v"), "r2")
    with pytest.raises(ValueError, match="n column_type_changed"):
        load(first.withColumn("n", F.lit("text")), "r3")
    load(first.select("v", "n", "k", F.lit(True).alias("extra")).withColumn("k", F.lit(2)), "r4")
    load(first.drop("v").withColumn("k", F.lit(3)), "r5", guard=False)
    kept = (ws.partitioned("t") if buckets else ws.target("t")).read()
    assert sorted((r["k"], r["v"], r["extra"]) for r in kept.collect()) == [(1, "a", None), (2, "a", True), (3, None, None)]
