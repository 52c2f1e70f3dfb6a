"""Snapshots from a carried state, and dyadic validity intervals."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pitsync.functions.ordering import By
from pitsync.operators import snapshots
from pitsync.operators.snapshots import distinct_points, snapshot_asof, snapshot_valid
from pitsync.plans.carry import CarriedAsof
from pitsync.sources.sinks import SnapshotTable
from tests.conftest import rows

NOW = datetime(2024, 2, 1)


def _versions(spark, seed, n, low, high, first):
    rng = random.Random(seed)
    made = [(first + k, rng.randrange(12), date.fromordinal(rng.randrange(low, high)), rng.choice("abc")) for k in range(n)]
    return spark.createDataFrame(made, "v long, id int, day date, x string")


@pytest.mark.parametrize("as_time", [False, True])
def test_three_increments_equal_the_whole(spark, folder, as_time):
    base = date(2024, 1, 1).toordinal()
    parts = [_versions(spark, n, 60, base + 30 * n, base + 30 * (n + 1), 100 * n) for n in range(3)]
    if as_time:
        parts = [p.withColumn("day", F.col("day").cast("timestamp_ntz") + F.expr("make_interval(0, 0, 0, 0, int(v % 24))")) for p in parts]
    spine = spark.createDataFrame([(date.fromordinal(base + d),) for d in (5, 10, 29, 31, 44, 59, 60, 75, 120)], "p date")
    carried = CarriedAsof(SnapshotTable(spark, f"{folder}/state"), ["id"], "day", ties=[By("v")])
    for n, part in enumerate(parts):
        part.write.parquet(f"{folder}/in{n}")
        part = spark.read.parquet(f"{folder}/in{n}")
        until = date.fromordinal(base + (29, 58, 200)[n])  # the second stops a day short of its increment
        snapshot, commit = carried.advance(part, spine.where(F.col("p") <= F.lit(until)), f"r{n}", NOW)
        read = set(snapshot.inputFiles())
        assert not any(f"/in{k}/" in f for f in read for k in range(n)), "an old increment is read"
        snapshot.write.mode("append").parquet(f"{folder}/out")
        commit()
        assert carried.advance(part, spine, f"r{n}", NOW) is None
    whole = snapshot_asof(parts[0].union(parts[1]).union(parts[2]), spine, ["id"], "day", ties=[By("v")])
    assert rows(spark.read.parquet(f"{folder}/out"), "p", "id") == rows(whole, "p", "id")
    assert carried.table.read().count() == 12  # one version per id


def test_late_versions_and_runs_without_points(spark, folder):
    day = lambda d: date(2024, 1, d)
    frame = lambda *r: spark.createDataFrame(list(r), "id int, day date, x string")
    points = lambda *d: spark.createDataFrame([(day(x),) for x in d], "p date")
    strict = CarriedAsof(SnapshotTable(spark, folder), ["id"], "day", late="reject")
    snapshot, commit = strict.advance(frame((1, day(3), "a"), (2, day(20), "later")), points(10), "r1", NOW)
    assert rows(snapshot) == [(1, day(3), "a", day(10))]
    commit()
    assert strict.done_until() == day(10)
    with pytest.raises(ValueError, match="2024-01-10"):
        strict.advance(frame((1, day(9), "late")), points(20), "r2", NOW)
    lenient = CarriedAsof(SnapshotTable(spark, folder), ["id"], "day")
    snapshot, commit = lenient.advance(frame((1, day(9), "late"), (None, day(11), "null id")), points(10), "r2", NOW)
    assert rows(snapshot) == []
    commit()
    snapshot, _ = lenient.advance(frame((3, None, "undated")), points(10, 25), "r3", NOW)
    assert rows(snapshot) == [(None, day(11), "null id", day(25)), (1, day(9), "late", day(25)), (2, day(20), "later", day(25))]


def _nodes(low, high):
    """The pieces of an interval by halving, top down."""

    def cut(level, at):
        first, last = at << level, ((at + 1) << level) - 1
        if last < low or first > high:
            return []
        return [(level, at)] if low <= first and last <= high else cut(level - 1, 2 * at) + cut(level - 1, 2 * at + 1)

    return sorted(cut(12, 0))


def test_nodes_of_an_interval(spark):
    pairs = [(a, b) for a in range(34) for b in range(a, 34)] + [(0, 4095), (1, 4094), (1023, 3000), (2048, 2048)]
    df = spark.createDataFrame(pairs, "__low int, __high int").withColumn("n", snapshots._dyadic_nodes())
    for r in df.collect():
        assert sorted(map(tuple, r["n"])) == _nodes(r["__low"], r["__high"])


def test_dyadic_snapshots_equal_the_others_and_shuffle_less(spark):
    rng, base = random.Random(1), date(2020, 1, 1).toordinal()
    made = []
    for k in range(6000):
        start = rng.randrange(300)
        end = None if k % 50 == 0 else date.fromordinal(base + start + rng.randrange(-1, 300))
        made.append((k % 20, date.fromordinal(base + start), end, k))
    df = spark.createDataFrame(made, "id int, s date, e date, v int")
    spine = distinct_points(spark.createDataFrame([(date.fromordinal(base + d),) for d in range(0, 400, 2)], "p date"), "p")
    for open_end in (False, True):
        results = [rows(snapshot_valid(df, spine, ["id"], "s", "e", ties=[By("v")], open_end=open_end, overlapping=kind), "id", "p") for kind in ("none", "spans", "dyadic")]
        assert results[0] == results[1] == results[2] and len(results[0]) > 2000
    spans = df.select("*", F.expr("int(datediff(s, date'2020-01-01')) div 2 + 1").cast("int").alias("__low"), F.expr("int(datediff(e, date'2020-01-01') div 2)").alias("__high"))
    sent = [snapshots.covering_spans(spans, ["id"], [By("s"), By("e")], None, d).agg(F.sum(F.expr("__high - __low + 1"))).first()[0] for d in (False, True)]
    print("rows multiplied by points:", sent)
    assert sent[1] * 10 < sent[0]
    with pytest.raises(ValueError, match="overlapping"):
        snapshot_valid(df, spine, ["id"], "s", "e", overlapping="other")
