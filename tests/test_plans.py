"""Column pruning, pushdown, and increments replayed."""

from __future__ import annotations

import datetime as dt
import random

import __spark_entry__ as driver
from pitsync.plans.sync import Workspace, export_table, import_table
from pitsync.spec import TableSpec
from tests.conftest import plan_of, rows

FOLDER = "/root/testdata/sf0.001"


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(driver.queries()["filtered_count"](spark, FOLDER))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    plan = plan_of(driver.queries()["validate_labels"](spark, FOLDER))
    assert "text" not in "".join(line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_increments_replayed_equal_one_full_load(spark, folder):
    """However append-only data is cut at marks, the target ends up the same."""
    rnd = random.Random(7)
    data = [(rnd.randrange(15), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i) for i in range(120)]
    src = spark.createDataFrame(data, "k int, at timestamp_ntz, v int")
    spec = TableSpec("t", "src", sync_mode="upsert", merge_keys=("k",), watermark="at", order_by="at")
    want = {}
    for k, at, v in data:
        want[k] = (k, at, v)
    for attempt in range(2):
        ws = Workspace(spark, f"{folder}/{attempt}")
        for run, cut in enumerate(sorted(rnd.sample(range(1, 119), 2)) + [120]):
            export_table(ws, spec, {"src": src.where(f"v < {cut}")}, f"r{run}")
            import_table(ws, spec, f"r{run}")
        assert rows(ws.target("t").read().select("k", "at", "v"), "k") == [want[k] for k in sorted(want)]
