from __future__ import annotations

import datetime as dt
import random

import pytest
from pitsync.functions.ordering import By
from pitsync.operators.merge import append, changed_partitions, full_load, upsert, upsert_chunks
from tests.conftest import plan_of, rows

BOTH = pytest.mark.parametrize("strategy", ["outer", "lookup"])


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10, dt.datetime(2023, 1, 1)), (2, "b", 20, dt.datetime(2023, 1, 1)), (3, "c", 30, dt.datetime(2023, 1, 1))],
        "id int, v string, only_target int, data_inserted_at timestamp_ntz",
    )


@BOTH
def test_update_insert_keep(spark, target, strategy):
    batch = spark.createDataFrame([(2, None, 1.5), (4, "d", 2.5)], "ID int, V string, extra double")
    out = upsert(target, batch, ["id"], run_ts=dt.datetime(2024, 1, 1), strategy=strategy)
    assert out.columns == ["id", "v", "only_target", "data_inserted_at", "extra"]
    assert rows(out, "id") == [
        (1, "a", 10, dt.datetime(2023, 1, 1), None),
        (2, None, 20, dt.datetime(2023, 1, 1), 1.5),
        (3, "c", 30, dt.datetime(2023, 1, 1), None),
        (4, "d", None, dt.datetime(2024, 1, 1), 2.5),
    ]


@BOTH
def test_batch_is_reduced_to_its_last_row(spark, target, strategy):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (1, "open", None)], "id int, v string, o int")
    out = upsert(target, batch, ["id"], [By("o")], strategy=strategy).where("id = 1")
    assert rows(out.select("v", "o")) == [("open", None)]


@BOTH
def test_null_keys(spark, target, strategy):
    batch = spark.createDataFrame([(None, "x"), (9, "y")], "id int, v string")
    with pytest.raises(Exception, match="NULL in merge key"):
        upsert(target, batch, ["id"], strategy=strategy).collect()
    once = upsert(target, batch, ["id"], null_keys="equal", strategy=strategy)
    assert once.count() == 5
    assert upsert(once, batch, ["id"], null_keys="equal", strategy=strategy).count() == 5


@BOTH
def test_empty_sides_and_key_only_batches(spark, target, strategy):
    batch = spark.createDataFrame([(1, "x"), (7, "y")], "id int, v string")
    assert rows(upsert(target, batch.limit(0), ["id"], strategy=strategy), "id") == rows(target, "id")
    assert upsert(target.limit(0), batch, ["id"], strategy=strategy).count() == 2
    only_keys = upsert(target, batch.select("id"), ["id"], strategy=strategy)
    assert [(r["id"], r["v"]) for r in only_keys.orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c"), (7, None)]


def test_keys_are_required(target):
    with pytest.raises(ValueError):
        upsert(target, target, [])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upsert_properties(spark, seed):
    rnd = random.Random(seed)

    def table(n):
        keys = rnd.sample(range(60), n)
        return {k: rnd.choice([None, rnd.randrange(100)]) for k in keys}

    def frame(d):
        return spark.createDataFrame(list(d.items()), "id int, v int")

    a, b = table(30), table(25)
    want = sorted(({**a, **b}).items())
    for strategy in ("outer", "lookup"):
        once = upsert(frame(a), frame(b), ["id"], strategy=strategy)
        assert rows(once, "id") == want
        assert rows(upsert(once, frame(b), ["id"], strategy=strategy), "id") == want  # idempotent
    assert rows(upsert(frame(a).limit(0), frame(b), ["id"]), "id") == sorted(b.items())  # full = upsert from empty


def test_composite_keys_and_widening(spark):
    target = spark.createDataFrame([("a", 1, 5)], "k string, m int, v int")
    batch = spark.createDataFrame([("a", 1, 2**40), ("a", 2, 7)], "k string, m int, v bigint")
    out = upsert(target, batch, ["k", "m"])
    assert dict(out.dtypes)["v"] == "bigint"
    assert rows(out, "m") == [("a", 1, 2**40), ("a", 2, 7)]


def test_full_and_append(spark, target):
    batch = spark.createDataFrame([(9, "z", 1.0)], "id int, v string, extra double")
    assert rows(full_load(target, batch).select("id", "only_target", "extra")) == [(9, None, 1.0)]
    assert append(target, batch).count() == 4
    assert append(target, batch).columns[-1] == "extra"


def test_later_chunks_win(spark, target):
    batch = spark.createDataFrame([(1, "c1", 1), (1, "c3", 3), (1, "c2", 2)], "id int, v string, chunk int")
    out = upsert_chunks(target, batch, ["id"], "chunk")
    assert out.where("id = 1").first()["v"] == "c3" and "chunk" not in out.columns


def test_lookup_does_not_shuffle_a_large_target(spark, folder):
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(f"{folder}/t")
    spark.range(5).selectExpr("id", "id + 1 AS v").write.parquet(f"{folder}/b")
    target, batch = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/b")
    plan = plan_of(upsert(target, batch, ["id"], strategy="lookup", deduplicated=True))
    assert "hashpartitioning" not in plan
    assert "hashpartitioning" in plan_of(upsert(target, batch, ["id"], deduplicated=True))


def test_only_touched_partitions_are_read(spark, folder):
    spark.range(100).selectExpr("id", "CAST(id % 10 AS INT) AS p").write.partitionBy("p").parquet(f"{folder}/t")
    target = spark.read.parquet(f"{folder}/t")
    batch = spark.createDataFrame([(3, 3), (13, 3)], "id bigint, p int")
    touched = changed_partitions(target, batch, ["p"])
    assert {r["p"] for r in touched.select("p").distinct().collect()} == {3}
    assert "(p#" in plan_of(touched).split("PartitionFilters: ")[1].splitlines()[0]
    many = changed_partitions(target, batch, ["p"], listed=0)
    assert {r["p"] for r in many.collect()} == {3}
    pairs = changed_partitions(target, batch, ["p", "id"])
    assert {tuple(r) for r in pairs.select("id", "p").collect()} == {(3, 3), (13, 3)}


def test_hot_key_in_a_batch(spark):
    """A third of the batch repeats one key; the result has it once."""
    target = spark.range(100).selectExpr("id", "0L AS v")
    batch = spark.range(30_000).selectExpr("IF(id % 3 = 0, 7, id % 200) AS id", "id AS v")
    for strategy in ("outer", "lookup"):
        out = upsert(target, batch, ["id"], [By("v")], strategy=strategy)
        assert out.count() == 200
        assert out.where("id = 7").first()["v"] == 29_999 - 29_999 % 3
