"""Exporting and importing tables: plans, files, verification, state.

The driver loops over tables only. Every step on rows or files is a Spark job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.names import find
from pitsync.functions.ordering import By
from pitsync.operators.catalog import catalog, classify, evolve_decision, schema_diff
from pitsync.operators.dedupe import key_violations, latest_per_key
from pitsync.operators.merge import BUCKET, bucket_of, reject_null_keys, upsert
from pitsync.operators.project import LOAD_STAMP, normalise, stamp
from pitsync.operators.quality import failed, validate
from pitsync.plans.extract import plan_extract
from pitsync.sources.manifest import manifest, only_files, verify
from pitsync.sources.ranges import RangeTable
from pitsync.sources.sealed import SealedExport, seal_export
from pitsync.sources.sinks import (
    LayoutSpec,
    PartitionedTable,
    SnapshotTable,
    append_rows,
    arrange,
    read_log,
    upsert_partitions,
    write_layout,
)
from pitsync.sources.state import LoadCheckpoint, SyncState, pending_files
from pitsync.spec import TableSpec

RUN_LOG = (
    "run_id string, run_type string, table_name string, sync_mode string, row_count long, "
    "duration_seconds double, watermark_advanced_to string, failed boolean, error string, finished_at timestamp_ntz"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Workspace:
    """Where one environment keeps its exports, targets and bookkeeping."""

    spark: SparkSession
    root: str

    @property
    def state(self) -> SyncState:
        return SyncState(self.spark, f"{self.root}/sync_state")

    @property
    def checkpoint(self) -> LoadCheckpoint:
        return LoadCheckpoint(self.spark, f"{self.root}/load_checkpoint")

    def export_path(self, run_id: str, table: str) -> str:
        return f"{self.root}/exports/{run_id}/{table}"

    def manifest_path(self, run_id: str, table: str) -> str:
        return f"{self.root}/manifests/{run_id}/{table}"

    def target(self, table: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/targets/{table}")

    def partitioned(self, table: str) -> PartitionedTable:
        return PartitionedTable(self.spark, f"{self.root}/targets/{table}")

    def ranges(self, table: str) -> RangeTable:
        """The export of a table that is kept in key ranges."""
        return RangeTable(self.spark, f"{self.root}/ranges/{table}")

    def range_target(self, table: str) -> RangeTable:
        return RangeTable(self.spark, f"{self.root}/targets/{table}")

    def stage_path(self, run_id: str, table: str) -> str:
        return f"{self.root}/stage/{run_id}/{table}"

    def run_log(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/run_log", RUN_LOG)

    def log_run(self, *row: Any) -> None:
        append_rows(self.spark, f"{self.root}/run_log", RUN_LOG, [row])


def export_table(
    ws: Workspace,
    spec: TableSpec,
    tables: Mapping[str, DataFrame],
    run_id: str,
    full_reload: bool = False,
    layout: LayoutSpec | None = None,
    monotonic: bool = False,
    run_ts: datetime | None = None,
    point_mark: Any = None,
    password: str | None = None,
) -> dict[str, Any]:
    """Extract what changed, write it, list its files, and move the mark.

    The plan runs once, into the files; row counts and the new mark are gathered on the
    way, and checksums are then read from the files. The mark moves last, and only if rows
    were written, so an export that dies anywhere is simply repeated. With a ``password``
    the rows are written in sealed frames (see ``sources.sealed``).
    """
    run_ts = run_ts or utc_now()
    tracked = bool(spec.watermark) and spec.sync_mode in ("incremental", "upsert")
    mark = ws.state.get(spec.name) if tracked and not full_reload else None
    df = plan_extract(ws.spark, spec, tables, mark, full_reload, point_mark)
    layout = layout or LayoutSpec(sort_keys=spec.sort_keys)
    path = ws.export_path(run_id, spec.name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    column = find(df, spec.watermark) if spec.watermark else None
    if column:
        metrics.append(F.max(column).cast("string").alias("mark"))
    if password is None:
        totals = write_layout(df, path, layout, mode="overwrite", metrics=metrics)
        listed = manifest(ws.spark, path)
    else:
        seen, context = Observation(), sealed_context(spec.name, run_id)
        seal_export(arrange(df, layout).observe(seen, *metrics), path, password, context)
        totals, export = seen.get, SealedExport(ws.spark, path, password, context)
        listed = export.manifest(export.streams())
    listed.withColumns({"table_name": F.lit(spec.name), "run_id": F.lit(run_id)}).write.mode("overwrite").parquet(
        ws.manifest_path(run_id, spec.name)
    )
    new_mark = totals["mark"] if column else None
    # a column of NULLs gives no mark; the run's time can stand in where it is of that kind
    timed = column is None or isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    if tracked and totals["rows"] > 0 and (new_mark is not None or timed):
        as_type = df.schema[column].dataType.simpleString() if column and monotonic else None
        ws.state.update(spec.name, new_mark or str(run_ts), totals["rows"], run_ts, run_id, as_type)
    return {
        "table_name": spec.name,
        "rows": totals["rows"],
        "sync_mode": spec.sync_mode,
        "mark": new_mark,
        "mark_used": mark,
        "path": path,
    }


def export_ranges(ws: Workspace, spec: TableSpec, tables: Mapping[str, DataFrame], run_id: str, digits: int = 2) -> dict[str, Any]:
    """Export a full table in key ranges; of equal ranges nothing is written."""
    if spec.sync_mode != "full" or not spec.merge_keys:
        raise ValueError(f"{spec.name}: exports in key ranges need mode full and merge_keys")
    df = plan_extract(ws.spark, spec, tables, None, True)
    done = ws.ranges(spec.name).update(df, spec.merge_keys, run_id, digits, LayoutSpec(sort_keys=spec.sort_keys))
    return {"table_name": spec.name, "sync_mode": spec.sync_mode, "rows": done["rows_written"], **done}


def import_ranges(ws: Workspace, spec: TableSpec, run_id: str) -> dict[str, Any]:
    """Bring a target to its export in key ranges by the ranges that differ."""
    target = ws.range_target(spec.target or spec.name)
    done = target.pull(ws.ranges(spec.name), run_id, LayoutSpec(sort_keys=spec.sort_keys))
    return {"table_name": spec.name, "sync_mode": spec.sync_mode, "rows": done["rows_written"], **done}


def sealed_context(table: str, run_id: str) -> str:
    """What the frames of an export are bound to: they open as this table and run only."""
    return f"{table}@{run_id}"


def import_table(
    ws: Workspace,
    spec: TableSpec,
    run_id: str,
    truncate: bool = False,
    layout: LayoutSpec | None = None,
    run_ts: datetime | None = None,
    password: str | None = None,
    guard_schema: bool = False,
) -> dict[str, Any]:
    """Verify an export, apply it to its target by the spec's mode, check, publish.

    Files already in the target are skipped, so a repeated import changes nothing. A sealed
    export needs its ``password``; of its frames, all must open, each in its place. With
    ``guard_schema`` a batch that would break readers of the target is refused.
    """
    run_ts = run_ts or utc_now()
    spark, path = ws.spark, ws.export_path(run_id, spec.name)
    listed = spark.read.parquet(ws.manifest_path(run_id, spec.name))
    export = None
    if password is not None:
        export = SealedExport(spark, path, password, sealed_context(spec.name, run_id))
        streams = export.streams()
        write_layout(streams, f"{ws.stage_path(run_id, spec.name)}/streams", LayoutSpec(), "overwrite")
        streams = spark.read.schema(streams.schema).parquet(f"{ws.stage_path(run_id, spec.name)}/streams")
        wrong = export.problems(streams)
        if wrong:
            raise ValueError(f"{spec.name}: " + "; ".join(wrong))
        present = export.manifest(streams)
    else:
        present = manifest(spark, path)
    bad = verify(listed, present).where(F.col("status").isin("mismatch", "missing"))
    problem = bad.orderBy("file").limit(1).first()
    if problem is not None:
        raise ValueError(f"{spec.name}: file {problem['file']} is {problem['status']}")

    fresh = truncate or spec.sync_mode == "full"
    if fresh:
        todo, commit_id = listed, f"{run_id}-full-{run_ts:%Y%m%d%H%M%S%f}"
    else:
        todo, commit_id = pending_files(listed, ws.checkpoint.loaded(spec.name)), run_id
    due = todo.agg(F.sum("rows").alias("rows")).first()["rows"]  # NULL: no file is due
    # files that came into the folder some other way are no part of the delivery
    batch = only_files(spark.read.parquet(path), path, todo) if export is None else export.read(todo)
    if not fresh:
        published = ws.target(spec.target or spec.name).is_published(run_id)
        if published or not due:
            if due is not None:
                ws.checkpoint.mark(spec.name, todo)
            return {"table_name": spec.name, "rows": 0, "sync_mode": spec.sync_mode, "skipped": True}
    batch = normalise(batch)
    check_batch(spec, batch)
    if guard_schema:
        hold_schema(ws, spec, batch)
    rows = apply_batch(ws, spec, batch, commit_id, fresh, layout, run_ts, due or 0)
    ws.checkpoint.mark(spec.name, todo)
    return {"table_name": spec.name, "rows": rows, "sync_mode": spec.sync_mode, "skipped": False}


def check_batch(spec: TableSpec, batch: DataFrame) -> None:
    """Hold a batch against the columns and rules of its spec, before anything is written.

    Types that do not fit the target's are found when the two are merged, which happens
    before anything is published as well.
    """
    absent = [c for c in (*spec.merge_keys, *spec.index_columns) if find(batch, c) is None]
    if absent:
        raise ValueError(f"{spec.name}: no column {', '.join(absent)}")
    if spec.rules:
        broken = failed(validate(batch, spec.rules)).collect()  # a few per rule
        if broken:
            raise ValueError(f"{spec.name}: " + "; ".join(f"{r[0]} {r[1]}: {r['detail']}" for r in broken))


def hold_schema(ws: Workspace, spec: TableSpec, batch: DataFrame) -> None:
    """Refuse a batch whose columns break those of its target: removed ones, and types that
    do not hold all values of the old ones. Only schemas are compared, no rows; places of
    columns do not count, as they are matched by name."""
    table = spec.target or spec.name
    old = (ws.partitioned(table) if spec.partition_by or spec.buckets else ws.target(table)).read()
    if old is None:
        return
    old, new = (catalog(ws.spark, {table: df.drop(LOAD_STAMP, BUCKET)}) for df in (old, batch))
    changes = classify(schema_diff(old, new).where("change <> 'column_position_changed'"))
    decision = evolve_decision(changes).first()
    if decision is not None and decision["status"] == "blocked":
        broken = changes.where("NOT safe").orderBy("column_name", "change").collect()  # a few per column
        raise ValueError(f"{spec.name}: " + "; ".join(f"{r['column_name']} {r['change']}" for r in broken))


def apply_batch(
    ws: Workspace,
    spec: TableSpec,
    batch: DataFrame,
    run_id: str,
    fresh: bool = False,
    layout: LayoutSpec | None = None,
    run_ts: datetime | None = None,
    expected: int | None = None,
) -> int:
    """Apply a lower-cased batch to the target; returns the rows written: the new target's,
    or the batch's where it was appended or the target is partitioned.

    ``expected`` is the number of rows that a full or appended batch should have. Rows are
    counted while they are written, and nothing is published if there are others.
    """
    run_ts = run_ts or utc_now()
    table = spec.target or spec.name
    target = ws.target(table)
    keys = [k.lower() for k in spec.merge_keys]
    layout = layout or LayoutSpec(sort_keys=tuple(keys))
    if spec.partition_by or spec.buckets:
        return _apply_partitioned(ws, spec, batch, run_id, fresh, layout, run_ts)

    is_append = spec.sync_mode == "incremental" and not fresh
    if spec.sync_mode == "upsert":
        order = [By(spec.watermark.lower())] if spec.watermark and find(batch, spec.watermark) else []
        stage = ws.stage_path(run_id, table)
        write_layout(latest_per_key(reject_null_keys(batch, keys), keys, order), stage, LayoutSpec(), "overwrite")
        staged = ws.spark.read.parquet(stage)
        old = None if fresh else target.read()
        if old is None:
            result = stamp(staged, run_ts)
        else:
            result = upsert(old, staged, keys, run_ts=run_ts, strategy=spec.upsert_strategy, deduplicated=True)
    else:
        result = stamp(batch, run_ts)

    written, rows = target.write(result, run_id, layout)
    if spec.sync_mode == "upsert":
        # One row per key on both sides of the merge makes the result unique already, so
        # the check is for targets that something else may have written.
        twice = None if not spec.verify_keys else key_violations(written, keys).limit(1).first()
        if twice is not None:
            raise ValueError(f"{table}: keys {keys} are not unique after the load")
    elif expected is not None and rows != expected:
        raise ValueError(f"{table}: {rows} rows loaded, {expected} expected")
    target.publish(run_id, rows, run_ts, is_append)
    return rows


def _apply_partitioned(
    ws: Workspace,
    spec: TableSpec,
    batch: DataFrame,
    run_id: str,
    fresh: bool,
    layout: LayoutSpec,
    run_ts: datetime,
) -> int:
    """Upsert that reads and rewrites only the partitions or key buckets the batch touches."""
    keys = [k.lower() for k in spec.merge_keys]
    parts = tuple(c.lower() for c in spec.partition_by)
    if spec.sync_mode != "upsert" or not set(parts) <= set(keys):
        raise ValueError("partitioned targets need mode upsert and partition columns among the merge keys")
    if spec.buckets:
        batch, parts = batch.withColumn(BUCKET, bucket_of(keys, spec.buckets)), (*parts, BUCKET)
    order = [By(spec.watermark.lower())] if spec.watermark and find(batch, spec.watermark) else []
    table = spec.target or spec.name
    stage = ws.stage_path(run_id, table)
    return upsert_partitions(ws.partitioned(table), batch, keys, order, parts, stage, layout, run_ts, fresh, spec.buckets or None)


def run_tables(
    ws: Workspace,
    specs: Sequence[TableSpec],
    step: Callable[[TableSpec], dict[str, Any]],
    run_id: str,
    run_type: str,
    only: str | None = None,
    parallel: int = 1,
) -> list[dict[str, Any]]:
    """Run one step per table; a failing table is logged and does not stop the others."""
    chosen = [s for s in specs if only is None or s.name.lower() == only.lower()]
    if only is not None and not chosen:
        raise ValueError(f"no table named {only!r}")

    def one(spec: TableSpec) -> dict[str, Any]:
        began = time.monotonic()
        if parallel > 1:  # with FAIR scheduling, tables share the cluster instead of queueing
            ws.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            result = {**step(spec), "error": None}
        except Exception as err:  # noqa: BLE001 - one table must not stop the run
            result = {"table_name": spec.name, "rows": 0, "sync_mode": spec.sync_mode, "error": str(err)}
        result["duration_seconds"] = round(time.monotonic() - began, 2)
        return result

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(one, chosen))
    else:
        results = [one(s) for s in chosen]
    for r in results:
        ws.log_run(
            run_id, run_type, r["table_name"], r["sync_mode"], r["rows"], r["duration_seconds"],
            r.get("mark"), r["error"] is not None, r["error"], utc_now(),
        )
    return results
