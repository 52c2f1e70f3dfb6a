"""Sealed exports: round trips, and every way a frame can be tampered with."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitsync.plans.sync import Workspace, export_table, import_table
from pitsync.sources.sealed import SealedExport, seal_export
from pitsync.spec import TableSpec
from tests.conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(0, 2000, 1, 3).select(
        F.col("id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 50).alias("text"), F.array(F.lit(None).cast("int"), F.col("id").cast("int")).alias("a"),
        F.create_map(F.lit("k"), F.col("id") / 7).alias("m"), F.expr("CAST(id AS DECIMAL(20, 3))").alias("d"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id)").alias("t"),
        F.when(F.col("id") % 5 > 0, F.encode(F.col("id").cast("string"), "utf-8")).alias("b"),
    )
    return df


@pytest.fixture
def export(spark, frame, folder):
    numbers = seal_export(frame, folder, "secret", "t@1", frame_bytes=8192)
    assert numbers["streams"] == 3 and numbers["rows"] == 2000 and numbers["frames"] > 12
    return folder


def _changed(spark, root, to, change):
    """A copy of an export with its frames changed."""
    spark.read.parquet(f"{root}/summary").write.parquet(f"{to}/summary")
    change(spark.read.parquet(f"{root}/frames")).write.parquet(f"{to}/frames")
    return SealedExport(spark, to, "secret", "t@1")


def test_rows_types_and_nulls_come_back(spark, frame, export):
    opened = SealedExport(spark, export, "secret", "t@1")
    assert opened.problems() == []
    assert opened.read().schema == frame.schema
    assert rows(opened.read(), "id") == rows(frame, "id")
    sizes = opened.frames.select(F.max("rows"), F.max(F.length("sealed"))).first()
    assert sizes[0] < 200 and sizes[1] < 12_000
    some = opened.manifest(opened.streams()).where("file = 'stream=1'")
    assert 0 < opened.read(some).count() < 2000


def test_a_row_above_the_bound_and_no_rows(spark, folder):
    df = spark.range(3).select("id", F.repeat(F.lit("y"), 50_000).alias("text"))
    assert seal_export(df, f"{folder}/a", "p", "c", frame_bytes=1000)["frames"] == 3
    assert rows(SealedExport(spark, f"{folder}/a", "p", "c").read(), "id") == rows(df, "id")
    assert seal_export(df.where("id > 9"), f"{folder}/b", "p", "c") == {"streams": 0, "frames": 0, "rows": 0}
    empty = SealedExport(spark, f"{folder}/b", "p", "c")
    assert empty.problems() == [] and empty.read().count() == 0


def test_wrong_password_and_other_context(spark, export):
    for password, context in (("other", "t@1"), ("secret", "t@2")):
        with pytest.raises(ValueError, match="does not open"):
            SealedExport(spark, export, password, context)


def _flip(frames):
    byte = F.expr("concat(substring(sealed, 1, 40), X'00', X'01', substring(sealed, 43))")
    return frames.withColumn("sealed", F.when((F.col("stream") == 1) & (F.col("frame") == 2), byte).otherwise(F.col("sealed")))


def _swap(frames):
    return frames.withColumn("frame", F.when((F.col("stream") == 1) & F.col("frame").isin(1, 2), 3 - F.col("frame")).otherwise(F.col("frame")))


def _other_stream(frames):
    return frames.withColumn("stream", (F.col("stream") + 1) % 3)


def _rename(frames):
    return frames.withColumn("rows", F.col("rows") + 1)


def _end_early(frames):
    return frames.where("stream <> 1 OR frame < 3").withColumn("last", F.col("last") | ((F.col("stream") == 1) & (F.col("frame") == 2)))


@pytest.mark.parametrize("change", [_flip, _swap, _other_stream, _rename, _end_early])
def test_changed_and_misplaced_frames_do_not_open(spark, export, folder, change):
    bad = _changed(spark, export, f"{folder}/bad", change)
    assert any("unreadable" in p for p in bad.problems())
    with pytest.raises(Exception, match="AES|decrypt|crypt"):
        bad.read().count()


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        (lambda f: f.where("stream <> 1 OR frame <> 2"), "stream 1 is gap"),
        (lambda f: f.where("stream <> 1 OR frame > 0"), "stream 1 is gap"),
        (lambda f: f.where("stream <> 1 OR NOT last"), "stream 1 is cut"),
        (lambda f: f.union(f.where("stream = 1 AND frame = 2")), "stream 1 is repeated"),
        (lambda f: f.where("stream <> 1"), "2 of 3 streams"),
        (lambda f: f.limit(0), "0 of 3 streams"),
    ],
)
def test_dropped_repeated_and_cut_streams_are_found(spark, export, folder, change, problem):
    assert problem in "; ".join(_changed(spark, export, f"{folder}/bad", change).problems())


def test_frames_of_an_earlier_export_do_not_open(spark, frame, export, folder):
    seal_export(frame, f"{folder}/again", "secret", "t@1", frame_bytes=8192)
    old = spark.read.parquet(f"{folder}/again/frames")
    assert any("unreadable" in p for p in _changed(spark, export, f"{folder}/bad", lambda f: f.where("stream <> 1").union(old.where("stream = 1"))).problems())


def test_export_and_import_of_a_sealed_table(spark, folder):
    ws = Workspace(spark, folder)
    spec = TableSpec("t", "src", sync_mode="upsert", merge_keys=("id",), watermark="at", order_by="at")
    first = spark.range(100).selectExpr("id", "1 AS at", "CAST(id AS STRING) AS v")
    assert export_table(ws, spec, {"src": first}, "r1", password="pw")["mark"] == "1"
    for wrong in (None, "no"):
        with pytest.raises(Exception):  # noqa: B017 - no plain files, or a password that does not fit
            import_table(ws, spec, "r1", password=wrong)
    assert import_table(ws, spec, "r1", password="pw")["rows"] == 100
    assert import_table(ws, spec, "r1", password="pw")["skipped"]
    second = spark.range(90, 120).selectExpr("id", "2 AS at", "'new' AS v")
    export_table(ws, spec, {"src": first.union(second)}, "r2", password="pw")
    assert import_table(ws, spec, "r2", password="pw")["rows"] == 120
    assert ws.target("t").read().where("v = 'new'").count() == 30
    # a frame of r1 in place of one of r2
    spark.read.parquet(f"{ws.export_path('r1', 't')}/frames").write.mode("overwrite").parquet(f"{ws.export_path('r2', 't')}/frames")
    with pytest.raises(ValueError, match="unreadable"):
        import_table(ws, spec, "r2", truncate=True, password="pw")
