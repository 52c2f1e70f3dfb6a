"""Loads that must not lose, cut or confuse rows, whatever paths, types and keys they meet."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.secrets import seal_files
from pitsync.functions.types import wider_type
from pitsync.operators.changes import diff_rows, rows_to_write
from pitsync.operators.merge import append, bucket_of
from pitsync.operators.project import merge_schema
from pitsync.operators.quality import validate
from pitsync.operators.snapshots import snapshot_asof
from pitsync.plans.extract import plan_extract
from pitsync.plans.sync import Workspace, apply_batch, export_table, import_table
from pitsync.sources.manifest import manifest
from pitsync.sources.sinks import LayoutSpec, PartitionedTable, SnapshotTable, claim
from pitsync.spec import TableSpec
from pitsync.streaming.ingest import bucketed_batch, file_stream, upsert_batch, upsert_stream

NOW = dt.datetime(2024, 3, 1)


@pytest.mark.parametrize("name", ["a b", "a%b", "a%20b", "a+b", "a#b", "x/deep/x"])
@pytest.mark.parametrize("mode", ["full", "incremental", "upsert"])
def test_round_trip_under_odd_roots_ignores_stray_files(spark, folder, name, mode):
    ws = Workspace(spark, f"{folder}/{name}")
    spec = TableSpec("t", "t", sync_mode=mode, merge_keys=("id",), watermark="id", order_by="id")
    export_table(ws, spec, {"t": spark.range(10)}, "r1", run_ts=NOW)
    assert spark.read.parquet(ws.manifest_path("r1", "t")).agg(F.sum("rows"), F.min("rows")).first()[0] == 10
    spark.range(100, 103).write.mode("append").parquet(ws.export_path("r1", "t"))
    result = import_table(ws, spec, "r1", run_ts=NOW)
    assert not result["skipped"] and result["rows"] == 10
    assert sorted(r["id"] for r in ws.target("t").read().collect()) == list(range(10))


def test_partition_values_with_slashes_keep_their_names(spark, folder):
    df = spark.createDataFrame([(1, "x/y z"), (2, "p%q")], "id int, part string")
    df.write.partitionBy("part").parquet(f"{folder}/d")
    for checksum in ("file", "rows"):
        listed = manifest(spark, f"{folder}/d", checksum).collect()
        assert len(listed) == 2 and all(r["rows"] == 1 for r in listed)
    assert len({r["file"] for r in seal_files(spark, f"{folder}/d", "pw").select("file").collect()}) == 2


def test_a_manifest_that_disagrees_stops_the_load(spark, folder):
    ws = Workspace(spark, folder)
    spec = TableSpec("t", "t", sync_mode="incremental", watermark="id", order_by="id")
    export_table(ws, spec, {"t": spark.range(10)}, "r1", run_ts=NOW)
    path = ws.manifest_path("r1", "t")
    rows = spark.read.parquet(path).withColumn("rows", F.lit(0).cast("long")).collect()
    spark.createDataFrame(rows, spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="mismatch"):
        import_table(ws, spec, "r1", run_ts=NOW)
    assert ws.checkpoint.loaded().count() == 0


def test_streams_have_identities_of_their_own(spark, folder):
    table = SnapshotTable(spark, f"{folder}/target")
    for name, value in (("one", "a"), ("two", "b")):
        rows = spark.createDataFrame([(name, value)], "k string, v string")
        rows.write.parquet(f"{folder}/{name}")
        for _ in range(2):
            upsert_stream(file_stream(spark, f"{folder}/{name}", rows.schema), table, ["k"], ["v"], f"{folder}/c-{name}", lambda n: NOW)
    assert sorted(tuple(r) for r in table.read().collect()) == [("one", "a"), ("two", "b")]
    assert table.commits().count() == 2
    with pytest.raises(Exception, match="NULL in merge key"):
        upsert_batch(SnapshotTable(spark, f"{folder}/new"), ["k"], ["v"], lambda n: NOW)(rows.withColumn("k", F.lit(None).cast("string")), 0)


def test_types_that_do_not_fit_raise(spark):
    target = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "n int, d date")
    for bad in ("3.7D AS n", "timestamp'2024-01-01 10:00:00' AS d", "'x' AS n"):
        with pytest.raises(ValueError, match="in the target"):
            append(target, spark.sql(f"SELECT {bad}"))
    assert merge_schema(target.schema, spark.sql("SELECT 3.7D AS n").schema, "cast")["n"].dataType == T.IntegerType()
    assert append(target, spark.sql("SELECT 5000000000 AS n")).schema["n"].dataType == T.LongType()
    assert wider_type(T.DecimalType(38, 0), T.DecimalType(38, 10)) is None
    assert wider_type(T.DecimalType(30, 25), T.LongType()) is None
    assert wider_type(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2)


def test_null_ids_form_a_snapshot_group_and_null_keys_are_written(spark):
    df = spark.createDataFrame([(None, dt.date(2024, 1, 5), "a"), (1, dt.date(2024, 1, 6), "b")], "id int, d date, v string")
    spine = spark.createDataFrame([(dt.date(2024, 1, 31),)], "m date")
    assert sorted(r["v"] for r in snapshot_asof(df, spine, ["id"], "d").collect()) == ["a", "b"]
    new = df.withColumn("v", F.lit("z"))
    assert rows_to_write(new, diff_rows(df, new, ["id"]), ["id"]).count() == 2


def test_unknown_order_columns_raise(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, at int")
    spec = TableSpec("t", "t", merge_keys=("k",), order_by="aat")
    with pytest.raises(ValueError, match="aat"):
        plan_extract(spark, spec, {"t": df})
    assert plan_extract(spark, spec.with_(order_by="at"), {"t": df}).first()["at"] == 2
    assert plan_extract(spark, TableSpec("t", "t", merge_keys=("k",)), {"t": df}).count() == 1


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    out = {r["check"]: r["passed"] for r in validate(df, {"x": {"not_null": True, "null_rate_max": 0.5}}).collect()}
    assert out == {"not_null": False, "null_rate_max": False}


def test_an_all_null_number_moves_no_mark(spark, folder):
    ws = Workspace(spark, folder)
    spec = TableSpec("t", "t", sync_mode="incremental", watermark="n", order_by="n")
    export_table(ws, spec, {"t": spark.createDataFrame([(None,)], "n int")}, "r1", run_ts=NOW)
    assert ws.state.get("t") is None


def test_buckets_leave_untouched_files_alone(spark, folder):
    ws = Workspace(spark, folder)
    spec = TableSpec("t", "t", sync_mode="upsert", merge_keys=("id",), buckets=8)
    base = spark.range(200).withColumn("v", F.lit("old"))
    apply_batch(ws, spec, base, "r1", run_ts=NOW)
    files = lambda: set(glob.glob(f"{folder}/targets/t/partitions/**/*.parquet", recursive=True))
    before = files()
    batch = spark.createDataFrame([(5, "new"), (1000, "new")], "id long, v string")
    touched = {r[0] for r in batch.select(bucket_of(["id"], 8)).collect()}
    apply_batch(ws, spec, batch, "r2", run_ts=NOW)
    gone = before - files()
    assert gone and all(int(f.split("key_bucket=")[1].split("/")[0]) in touched for f in gone)
    rows = {r["id"]: r["v"] for r in ws.partitioned("t").read().collect()}
    assert rows == {i: "old" for i in range(200)} | {5: "new", 1000: "new"}


def test_bucketed_stream_batches_can_be_repeated(spark, folder):
    table = PartitionedTable(spark, f"{folder}/t")
    apply = bucketed_batch(table, ["k"], ["o"], 4, f"{folder}/stage")
    one = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    for number, batch in ((0, one), (0, one), (1, one.where("k = 2").withColumn("v", F.lit("d")))):
        apply(batch, number)
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [(1, "b"), (2, "d")]


def test_of_two_writers_of_a_version_one_fails(spark, folder):
    claim(spark, f"{folder}/v", 1)
    with pytest.raises(RuntimeError, match="taken"):
        claim(spark, f"{folder}/v", 1)


def test_appends_with_new_columns_are_one_read(spark, folder):
    table = SnapshotTable(spark, f"{folder}/t")
    for n in range(4):
        df = spark.range(n, n + 1)
        table.write(df if n < 2 else df.withColumn("extra", F.lit(n)), f"r{n}")
        table.publish(f"r{n}", 1, NOW, True)
    plan = table.read()._jdf.queryExecution().toString()
    assert "Union" not in plan
    assert sorted(map(tuple, table.read().collect())) == [(0, None), (1, None), (2, 2), (3, 3)]


def test_levels_out_of_range_raise():
    for compression, level in (("gzip", 10), ("zstd", 23), ("brotli", 12)):
        with pytest.raises(ValueError, match="levels"):
            LayoutSpec(compression=compression, level=level)


def test_rules_and_columns_of_a_spec_are_checked_before_a_load(spark, folder):
    ws = Workspace(spark, folder)
    spec = TableSpec("t", "t", sync_mode="upsert", merge_keys=("id",), watermark="id", order_by="id", rules={"v": {"not_null": True}})
    export_table(ws, spec, {"t": spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS v")}, "r1", run_ts=NOW)
    with pytest.raises(ValueError, match="not_null"):
        import_table(ws, spec, "r1", run_ts=NOW)
    with pytest.raises(ValueError, match="no column w"):
        import_table(ws, spec.with_(rules={}, index_columns=("w",)), "r1", run_ts=NOW)
    assert ws.target("t").read() is None
    assert import_table(ws, spec.with_(rules={}), "r1", run_ts=NOW)["rows"] == 1
