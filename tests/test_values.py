"""Values that used to be taken for each other, and types that widen."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from pitsync.functions.types import wider_type
from pitsync.operators.changes import diff_rows, hash_groups
from pitsync.operators.dedupe import latest_per_key
from pitsync.operators.merge import bucket_of
from pitsync.plans.sync import Workspace, apply_batch
from pitsync.sources.manifest import manifest
from pitsync.spec import TableSpec
from pitsync.streaming.ingest import bucketed_batch

NESTED = [
    "array(1, 2, NULL)", "array(1, NULL, 2)", "array(NULL, 1, 2)", "array(1, 2)", "array()", "CAST(NULL AS ARRAY<INT>)",
]
STRUCTS = ["named_struct('a', 1, 'b', NULL)", "named_struct('a', NULL, 'b', 1)", "named_struct('a', NULL, 'b', NULL)", "CAST(NULL AS STRUCT<a: INT, b: INT>)"]
MAPS = ["map('k', 1)", "map('k', NULL)", "map('j', NULL)", "CAST(map() AS MAP<STRING, INT>)"]


@pytest.mark.parametrize(("kind", "values"), [("array<int>", NESTED), ("struct<a: int, b: int>", STRUCTS), ("map<string, int>", MAPS)])
def test_nulls_inside_nested_values_make_rows_differ(spark, kind, values):
    frames = [spark.sql(f"SELECT 1 AS id, CAST({v} AS {kind}) AS v") for v in values]
    for (i, old), (j, new) in itertools.product(enumerate(frames), repeat=2):
        assert diff_rows(old, new, ["id"]).first()["status"] == ("unchanged" if i == j else "changed")
    digests = [hash_groups(f, ["id"]).first()["row_hash"] for f in frames]
    assert len(set(digests)) == len(values)


def test_row_checksums_of_files_see_moved_nulls(spark, folder):
    for n, v in enumerate(NESTED[:2]):
        spark.sql(f"SELECT {v} AS v").coalesce(1).write.parquet(f"{folder}/{n}")
    sums = [manifest(spark, f"{folder}/{n}", "rows").first()["checksum_sha256"] for n in (0, 1)]
    assert sums[0] != sums[1]


def test_ties_between_rows_that_differ_in_nulls_or_maps_are_broken_alike(spark):
    rows = [(1, 1, None, {"a": 1}), (1, None, 1, {"a": 1}), (1, 1, None, {"a": 2}), (1, None, None, None)]
    schema = "k int, x int, y int, m map<string, int>"
    kept = set()
    for order in itertools.permutations(rows):
        kept.add(str(latest_per_key(spark.createDataFrame(list(order), schema).coalesce(1), ["k"], ["k"]).first()))
    assert len(kept) == 1


@pytest.mark.parametrize("narrow", ["tinyint", "smallint", "int", "bigint", "float", "decimal(9,2)", "decimal(18,4)"])
@pytest.mark.parametrize("wide", ["smallint", "int", "bigint", "double", "decimal(5,0)", "decimal(12,3)", "decimal(38,2)"])
def test_files_of_a_narrow_type_can_be_read_as_the_wider_one(spark, folder, narrow, wide):
    old, new = (spark.sql(f"SELECT CAST(7 AS {t}) AS v") for t in (narrow, wide))
    wider = wider_type(old.schema["v"].dataType, new.schema["v"].dataType)
    if wider is None:
        return
    old.write.mode("append").parquet(folder)
    new.select(F.col("v").cast(wider)).write.mode("append").parquet(folder)
    assert [float(r["v"]) for r in spark.read.schema(f"v {wider.simpleString()}").parquet(folder).collect()] == [7, 7]


@pytest.mark.parametrize("layout", [{}, {"buckets": 3}])
def test_a_target_stays_readable_when_bigint_becomes_decimal(spark, folder, layout):
    ws, spec = Workspace(spark, folder), TableSpec("t", "t", sync_mode="upsert", merge_keys=("id",), **layout)
    apply_batch(ws, spec, spark.range(20).selectExpr("id", "id * 10 AS v"), "r1")
    apply_batch(ws, spec, spark.range(5, 25).selectExpr("CAST(id AS DECIMAL(12, 2)) AS id", "CAST(id AS DECIMAL(10, 1)) AS v"), "r2")
    table = (ws.partitioned("t") if layout else ws.target("t")).read()
    assert sorted(int(r["id"]) for r in table.collect()) == list(range(25))


def test_another_number_of_buckets_is_refused(spark, folder):
    ws = Workspace(spark, folder)
    batch = spark.range(20).selectExpr("id", "1 AS v")
    spec = TableSpec("t", "t", sync_mode="upsert", merge_keys=("id",), buckets=8)
    apply_batch(ws, spec, batch, "r1")
    with pytest.raises(ValueError, match="8 key buckets, not 16"):
        apply_batch(ws, spec.with_(buckets=16), batch, "r2")
    with pytest.raises(ValueError, match="8 key buckets"):
        bucketed_batch(ws.partitioned("t"), ["id"], [], 4, f"{folder}/s")(batch, 0)
    apply_batch(ws, spec, batch, "r3")
    assert ws.partitioned("t").read().count() == 20
    apply_batch(ws, spec.with_(buckets=16), batch, "r4", fresh=True)
    assert ws.partitioned("t").read().count() == 20
    assert ws.partitioned("t").read().select("key_bucket").distinct().count() > 8


def test_buckets_of_widened_keys(spark):
    kinds = ("int", "bigint", "decimal(12,0)", "decimal(20,6)")
    for value in ("0", "10", "-7", "1200"):
        assert len({spark.sql(f"SELECT CAST({value} AS {k}) AS k").select(bucket_of(["k"], 1000)).first()[0] for k in kinds}) == 1
    a, b = (spark.sql(f"SELECT CAST(1.5 AS {k}) AS k").select(bucket_of(["k"], 1000)).first()[0] for k in ("decimal(5,1)", "decimal(9,4)"))
    assert a == b
