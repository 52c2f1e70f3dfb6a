"""Exports in key ranges: what is written, and what is left alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitsync.sources import ranges, sinks
from pitsync.sources.ranges import RangeTable, compare_trees
from pitsync.sources.sinks import LayoutSpec
from tests.conftest import plan_of, rows


def _files(spark, root):
    return {r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/data").select("path").collect()}


def test_only_ranges_that_differ_are_written(spark, folder):
    table, df = RangeTable(spark, folder), spark.range(3000).selectExpr("id", "id * 2 AS v", "array(CAST(NULL AS INT), CAST(id AS INT)) AS a")
    first = table.update(df, ["id"], "r1")
    assert first["written"] == first["ranges"] == 256 and first["rows_written"] == 3000
    before = _files(spark, folder)
    assert table.update(df.repartition(5), ["id"], "r2")["written"] == 0
    assert _files(spark, folder) == before and table.head()["run_id"] == "r1"

    one = df.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    done = table.update(one, ["id"], "r3")
    assert done["written"] == 1 and done["rows_written"] < 40
    assert len(_files(spark, folder) ^ before) == 2
    assert rows(table.read(), "id") == rows(one, "id")

    moved = one.withColumn("a", F.when(F.col("id") == 5, F.array(F.lit(5), F.lit(None).cast("int"))).otherwise(F.col("a")))
    assert table.update(moved, ["id"], "r4")["written"] == 1
    swapped = moved.withColumn("v", F.when(F.col("id") == 1, 4).when(F.col("id") == 2, 2).otherwise(F.col("v")))
    assert table.update(swapped, ["id"], "r5")["written"] == 2


def test_ranges_that_run_empty_are_gone_and_come_back(spark, folder):
    table, df = RangeTable(spark, folder), spark.range(40).selectExpr("id", "CAST(id AS STRING) AS v")
    table.update(df, ["id"], "r1")
    done = table.update(df.where("id < 20"), ["id"], "r2")
    assert done["deleted"] > 0 and rows(table.read(), "id") == rows(df.where("id < 20"), "id")
    assert table.update(df.where("id < 0"), ["id"], "r3")["written"] == 0 and table.read().count() == 0
    table.update(df, ["id"], "r4")
    assert rows(table.read(), "id") == rows(df, "id")


def test_a_target_pulls_the_ranges_that_differ(spark, folder):
    source, target = RangeTable(spark, f"{folder}/a"), RangeTable(spark, f"{folder}/b")
    with pytest.raises(ValueError, match="holds nothing"):
        target.pull(source, "r0")
    df = spark.range(500).selectExpr("id", "id AS v", "IF(id % 3 = 0, NULL, id) AS k")
    source.update(df, ["k", "id"], "r1", digits=1)
    assert target.pull(source, "r1")["rows_written"] == 500
    source.update(df.where("id <> 9").union(spark.sql("SELECT 900L, 1L, CAST(NULL AS BIGINT)")), ["k", "id"], "r2", digits=1)
    assert 1 <= target.pull(source, "r2")["written"] <= 2
    assert target.pull(source, "r3") == {"ranges": 16, "written": 0, "deleted": 0, "rows_written": 0}
    assert rows(target.read(), "id") == rows(source.read(), "id") and target.read().count() == 500


def test_other_columns_rewrite_all_and_other_ranges_are_refused(spark, folder):
    table, df = RangeTable(spark, folder), spark.range(100).selectExpr("id", "1 AS v")
    table.update(df, ["id"], "r1", digits=1)
    wider = df.withColumn("w", F.lit("x"))
    assert table.update(wider, ["id"], "r2", digits=1)["written"] == 16
    assert rows(table.read(), "id") == rows(wider, "id")
    with pytest.raises(ValueError, match="by 1 digits"):
        table.update(wider, ["id"], "r3", digits=2)
    with pytest.raises(ValueError, match="ranges of"):
        table.update(wider, ["v"], "r3", digits=1)


def test_trees_are_compared_below_differing_nodes_only(spark):
    schema = "leaf string, rows long, digest string"
    old = spark.createDataFrame([("00", 1, "a"), ("01", 1, "b"), ("10", 1, "c"), ("20", 1, "d")], schema)
    new = spark.createDataFrame([("00", 1, "a"), ("01", 1, "x"), ("10", 1, "c"), ("30", 1, "e")], schema)
    assert rows(compare_trees(old, new), "leaf") == [("01", "changed"), ("20", "deleted"), ("30", "new")]
    assert compare_trees(old, old).count() == 0 and compare_trees(old.limit(0), old.limit(0)).count() == 0


def test_a_pull_writes_ranges_as_they_lie(spark, folder, monkeypatch):
    source, target, plans = RangeTable(spark, f"{folder}/a"), RangeTable(spark, f"{folder}/b"), []
    df = spark.range(900).selectExpr("id", "id % 7 AS v")
    source.update(df, ["id"], "r1", digits=1, layout=LayoutSpec(max_records=20))
    write = ranges.write_layout

    def noted(df, path, layout, *rest):
        if path.endswith("/data"):
            plans.append(plan_of(sinks.arrange(df, layout)))
        return write(df, path, layout, *rest)

    monkeypatch.setattr(ranges, "write_layout", noted)
    assert target.pull(source, "r1", LayoutSpec(sort_keys=("v",)))["rows_written"] == 900
    assert "rebalance" not in plans[0].lower() and "hashpartitioning" not in plans[0] and "sha2" not in plans[0]
    assert rows(target.read(), "id") == rows(df, "id") and target.read().columns == df.columns
    changed = df.withColumn("v", F.when(F.col("id") < 40, 9).otherwise(F.col("v")))
    source.update(changed, ["id"], "r2", digits=1)
    target.pull(source, "r2")
    assert rows(target.read(), "id") == rows(changed, "id")
