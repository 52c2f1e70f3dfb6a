"""The read side of a table spec as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitsync.functions.names import find
from pitsync.functions.ordering import By
from pitsync.operators.dedupe import latest_per_key
from pitsync.operators.filters import apply_filters, semi_filter, share_keys, since
from pitsync.operators.project import derive, unpack_json
from pitsync.operators.snapshots import distinct_points, snapshot_asof, snapshot_valid
from pitsync.sources.scan import read_source, scan
from pitsync.spec import DEFAULT_ORDER, TableSpec

PHASES = ("filter_then_dedup", "dedup_then_filter")


def _spine(spark: SparkSession, spec: TableSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    snap = spec.snapshot
    return distinct_points(scan(spark, tables, snap.spine_table), snap.spine_column, snap.point)


def ranking(df: DataFrame, spec: TableSpec) -> list[By]:
    """The order by which a key's row wins. A column the spec names must be there, or
    another row would win unnoticed; the default is left out where a table has none."""
    if find(df, spec.order_by) is None:
        if spec.order_by == DEFAULT_ORDER:
            return []
        raise ValueError(f"{spec.name}: no column {spec.order_by} to order by")
    return [By(spec.order_by)]


def _snapshot(df: DataFrame, spine: DataFrame, spec: TableSpec) -> DataFrame:
    snap = spec.snapshot
    ties = [By(t) for t in snap.ties] or None
    if snap.kind == "valid":
        return snapshot_valid(
            df, spine, snap.id, snap.start, snap.end, snap.point, ties=ties, overlapping=snap.overlapping
        )
    return snapshot_asof(df, spine, snap.id, snap.date, snap.point, ranking(df, spec), ties)


def _snapshot_increment(
    df: DataFrame, spine: DataFrame, spec: TableSpec, mark: Any, point_mark: Any
) -> DataFrame:
    """The snapshot rows above a mark, without building the whole snapshot.

    A row above the mark belongs to an id that has one in the source, so all other ids
    drop out before any shuffle of their history. Points after ``point_mark`` are wanted
    for every id; they form a snapshot of their own, over just those points.
    """
    recent = share_keys(df, since(df, spec.watermark, mark), spec.snapshot.id)
    if point_mark is None:
        return since(_snapshot(recent, spine, spec), spec.watermark, mark)
    point = F.col(spec.snapshot.point)
    bound = F.lit(point_mark).cast("date")
    seen = since(_snapshot(recent, spine.where(point <= bound), spec), spec.watermark, mark)
    return seen.unionByName(_snapshot(df, spine.where(point > bound), spec))


def plan_extract(
    spark: SparkSession,
    spec: TableSpec,
    tables: Mapping[str, DataFrame],
    mark: Any = None,
    full_reload: bool = False,
    point_mark: Any = None,
    phase: str | None = None,
) -> DataFrame:
    """Everything between the source and the sink of one table.

    Tables with a snapshot, or a query that is one row per key by itself, reduce first and
    filter outside; all others filter and apply the mark first, then take the latest row
    per merge key. The two orders give different results, so ``phase`` follows the spec.
    A membership filter on the id commutes with a reduction per id; it always runs first,
    before any row is multiplied by the spine. With ``point_mark``, a snapshot increment
    also holds all rows at spine points after it (see ``since``).
    """
    phase = phase or spec.phase
    if phase not in PHASES:
        raise ValueError(f"phase must be one of {PHASES}")
    df = read_source(spark, spec, tables)
    if spec.unpack:
        u = spec.unpack
        df = unpack_json(df, u.column, u.fields, u.keep, u.strict)
    if spec.derive:
        df = derive(df, spec.derive)

    member_early = spec.members is not None and (
        phase == "filter_then_dedup"
        or spec.members.on.lower() in {k.lower() for k in (*spec.merge_keys, *(spec.snapshot.id if spec.snapshot else ()))}
    )

    def members(frame: DataFrame) -> DataFrame:
        m = spec.members
        return semi_filter(frame, scan(spark, tables, m.table), m.on, m.column)

    tracked = spec.watermark is not None and spec.sync_mode != "full" and mark is not None and not full_reload

    def marked(frame: DataFrame) -> DataFrame:
        return since(frame, spec.watermark, mark) if tracked else frame

    def latest(frame: DataFrame) -> DataFrame:
        if spec.source_is_deduplicated or not spec.merge_keys:
            return frame
        return latest_per_key(frame, spec.merge_keys, ranking(frame, spec), [By(t) for t in spec.ties] or None)

    if member_early:
        df = members(df)
    if phase == "filter_then_dedup":
        df = marked(apply_filters(df, spec.filters))
        return _snapshot(df, _spine(spark, spec, tables), spec) if spec.snapshot else latest(df)

    if spec.snapshot and tracked:
        df = _snapshot_increment(df, _spine(spark, spec, tables), spec, mark, point_mark)
    elif spec.snapshot:
        df = _snapshot(df, _spine(spark, spec, tables), spec)
    else:
        if tracked and spec.merge_keys and not spec.source_is_deduplicated:
            # only keys with a row above the mark can have their latest row above it
            df = share_keys(df, marked(df), spec.merge_keys)
        df = marked(latest(df))
    if spec.members is not None and not member_early:
        df = members(df)
    return apply_filters(df, spec.filters)
