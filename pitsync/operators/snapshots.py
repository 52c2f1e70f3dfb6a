"""Point-in-time snapshots of versioned rows at the distinct dates of a spine.

A range join ``start < point <= end`` has no equality key, so Spark would compare every
row with every point. Here the spine becomes one array of dates plus an array that
maps each day to the first point on or after it. Dates bound both: the calendar
0001-9999 has 3.65 million days (about 15 MB as integers), a century of month ends 1200
entries. They enter as one scalar subquery, so each row finds its points by array
access, inside generated code, with no join and no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.names import require
from pitsync.functions.ordering import By, OrderKey
from pitsync.operators.dedupe import latest_per_key

_CAL = "__calendar"
_POINTS = "__points"


def distinct_points(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """The spine: distinct non-NULL dates of a column."""
    source = require(df, column)
    dates = df.select(F.col(source).cast("date").alias(name or source))
    return dates.where(F.col(name or source).isNotNull()).distinct()


def month_ends(df: DataFrame, column: str, name: str = "month_end") -> DataFrame:
    """The spine of month ends in which ``column`` has at least one date."""
    ends = df.select(F.last_day(require(df, column)).alias(name))
    return ends.where(F.col(name).isNotNull()).distinct()


def _calendar(spine: DataFrame, column: str) -> Column:
    if not isinstance(spine.schema[column].dataType, T.DateType):
        # dates bound the arrays, and rounding a time of day would move a point
        raise ValueError(f"spine column {column} must be a date; see distinct_points")
    points = spine.select(F.col(column).alias("p")).where("p IS NOT NULL")
    packed = points.agg(F.array_sort(F.collect_set("p")).alias("points")).select(
        F.struct(
            F.col("points"),
            F.get("points", F.lit(0)).alias("day0"),
            F.expr(
                "flatten(transform(points, (p, i) -> "
                "array_repeat(i, if(i = 0, 1, datediff(p, points[i - 1])))))"
            ).alias("first_at"),
        ).alias("calendar")
    )
    return packed.scalar()


def _first_point(day: Column) -> Column:
    """Index of the first point on or after ``day``; NULL beyond the last or for NULL."""
    offset = F.datediff(day, F.col(f"{_CAL}.day0"))
    return F.when(offset < 0, F.lit(0)).otherwise(F.get(F.col(f"{_CAL}.first_at"), offset))


def _emit(df: DataFrame, low: str, high: str, point: str) -> DataFrame:
    """One output row per spine point with index ``low`` to ``high``, both included."""
    span = F.slice(F.col(_POINTS), F.col(low) + 1, F.col(high) - F.col(low) + 1)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (low, high, _POINTS)]
    return df.where(F.col(low) <= F.col(high)).select(*kept, F.explode(span).alias(point))


OVERLAPS = ("none", "spans", "dyadic")


def _dyadic_nodes() -> Column:
    """The nodes of a binary tree over the points that make up ``__low`` to ``__high``.

    A node (level, at) covers the points at * 2^level and on. On each level the rest of the
    interval gives up a node at its left end if that is odd, and one at its right end; with
    l = ceil(low / 2^level) and r = floor((high + 1) / 2^level) both ends are known without
    the levels before. So a level has two nodes at most.
    """
    left, right = "(__low + shiftleft(1, k) - 1) div shiftleft(1, k)", "(__high + 1) div shiftleft(1, k)"
    nodes = (
        f"CASE WHEN {left} < {right} AND ({left}) % 2 = 1 THEN named_struct('level', k, 'at', int({left})) END",
        f"CASE WHEN {left} + ({left}) % 2 < {right} AND ({right}) % 2 = 1 THEN named_struct('level', k, 'at', int({right}) - 1) END",
    )
    levels = "sequence(0, int(floor(log2(__high + 1))))"
    return F.expr(f"filter(flatten(transform({levels}, k -> array({', '.join(nodes)}))), n -> n IS NOT NULL)")


def covering_spans(rows: DataFrame, ids: Sequence[str], order: Sequence[OrderKey], ties: Sequence[OrderKey] | None, dyadic: bool) -> DataFrame:
    """The versions that can be the best at some point, one per id and span of points.

    ``rows`` carry their points as ``__low`` to ``__high``. Spans are those of the versions
    themselves, of which n points allow n * n / 2 for an id, or nodes of a binary tree over the
    points, of which there are 2 * n: then a version stands for each of its nodes, at most
    2 * log2(n), and the best per node stays.
    """
    covering = rows.where(F.col("__low") <= F.col("__high"))
    if not dyadic:
        return latest_per_key(covering, [*ids, "__low", "__high"], order, ties)
    nodes = covering.withColumn("__node", F.explode(_dyadic_nodes())).drop("__low", "__high")
    best = latest_per_key(nodes.withColumns({"__level": F.col("__node.level"), "__at": F.col("__node.at")}).drop("__node"), [*ids, "__level", "__at"], order, ties)
    low = F.expr("int(__at * shiftleft(1, __level))")
    return best.withColumns({"__low": low, "__high": F.expr("int((__at + 1) * shiftleft(1, __level) - 1)")}).drop("__level", "__at")


def snapshot_valid(
    df: DataFrame,
    spine: DataFrame,
    id_columns: Sequence[str],
    start: str,
    end: str,
    point: str | None = None,
    order: Sequence[OrderKey] | None = None,
    ties: Sequence[OrderKey] | None = None,
    open_end: bool = False,
    overlapping: bool | str = True,
) -> DataFrame:
    """For every id and spine point the version with ``start < point <= end``.

    Overlapping versions are ranked by start, then end, both descending. A NULL end
    matches nothing, as in SQL; ``open_end`` lets it reach the last point instead.

    Versions of an id that cover the same points shrink to the best one before any is
    multiplied by its points; that step combines before its shuffle. So an id with
    billions of overlapping versions yields at most one per pair of points. With
    ``overlapping="dyadic"`` spans of points are cut along a binary tree first, and an id
    yields at most two versions per point: use it where long intervals overlap at many
    points (see ``covering_spans``). Where versions of an id are known not to overlap,
    ``overlapping=False`` saves that shuffle.
    """
    kind = {True: "spans", False: "none"}.get(overlapping, overlapping)
    if kind not in OVERLAPS:
        raise ValueError(f"overlapping must be one of {OVERLAPS}")
    spine_column = spine.columns[0]
    point = point or spine_column
    start, end = require(df, start), require(df, end)
    after_end = _first_point(F.date_add(F.col(end).cast("date"), 1))
    high = F.coalesce(after_end, F.size(F.col(f"{_CAL}.points"))) - 1
    if not open_end:
        high = F.when(F.col(end).isNotNull(), high)
    rows = df.withColumn(_CAL, _calendar(spine, spine_column)).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col(f"{_CAL}.points").alias(_POINTS),
        _first_point(F.date_add(F.col(start).cast("date"), 1)).alias("__low"),
        high.alias("__high"),
    )
    order = order or [By(start), By(end)]
    if kind != "none":
        best = covering_spans(rows.drop(_POINTS), id_columns, order, ties, kind == "dyadic")
        points = F.col(f"{_CAL}.points").alias(_POINTS)
        rows = best.withColumn(_CAL, _calendar(spine, spine_column)).select(*[F.col(f"`{c}`") for c in best.columns], points)
    versions = _emit(rows, "__low", "__high", point)
    return latest_per_key(versions, [*id_columns, point], order, ties)


def snapshot_asof(
    df: DataFrame,
    spine: DataFrame,
    id_columns: Sequence[str],
    date: str,
    point: str | None = None,
    order: Sequence[OrderKey] = (),
    ties: Sequence[OrderKey] | None = None,
) -> DataFrame:
    """For every id and spine point the row with the greatest ``date <= point``.

    Rows first shrink to the best one per id and next spine point; that step combines
    before the shuffle. Only then does a window look for the id's next row, over at most
    one row per point, so even an id holding a third of all rows stays a small group.
    ``order`` ranks rows of equal date. Rows with a NULL id form a group like any other.
    """
    spine_column = spine.columns[0]
    point = point or spine_column
    date = require(df, date)
    ids = [require(df, c) for c in id_columns]
    day = F.col(date).cast("date")
    if not isinstance(df.schema[date].dataType, T.DateType):
        day = F.date_add(day, F.when(F.col(date) > day.cast(df.schema[date].dataType), 1).otherwise(0))
    usable = F.col(date).isNotNull()
    calendar = _calendar(spine, spine_column)
    slots = (
        df.where(usable)
        .withColumn(_CAL, calendar)
        .select(*[F.col(f"`{c}`") for c in df.columns], _first_point(day).alias("__low"))
        .where(F.col("__low").isNotNull())
    )
    tie_order = ties if ties is not None else None
    best = latest_per_key(slots, [*ids, "__low"], [By(date), *order], tie_order)
    following = F.lead("__low").over(Window.partitionBy(*ids).orderBy("__low"))
    spans = (
        best.withColumn("__next", following)
        .withColumn(_CAL, calendar)
        .select(
            *[F.col(f"`{c}`") for c in df.columns],
            "__low",
            (F.coalesce(F.col("__next"), F.size(F.col(f"{_CAL}.points"))) - 1).alias("__high"),
            F.col(f"{_CAL}.points").alias(_POINTS),
        )
    )
    return _emit(spans, "__low", "__high", point)


def carry_forward(
    state: DataFrame | None,
    increment: DataFrame,
    points: DataFrame,
    id_columns: Sequence[str],
    date: str,
    order: Sequence[OrderKey] = (),
    ties: Sequence[OrderKey] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``snapshot_asof`` at new points, and the state from which the next ones follow.

    ``state`` is what an earlier call returned (None at first) and ``increment`` the versions
    that have come since; ``points`` are all above those of earlier calls. The new state
    holds the last version per id as of the last point, and versions dated after it. So
    what is read grows with ids and news, never with history.
    """
    versions = increment if state is None else state.unionByName(increment)
    column = points.columns[0]
    snapshot = snapshot_asof(versions, points, id_columns, date, None, order, ties)
    until = points.agg(F.max(column).alias("until")).scalar()
    day = require(versions, date)
    dated = versions.where(F.col(day).isNotNull()).withColumn("__until", until)
    # by the end of the day, as in snapshot_asof, a version counts at midnight
    due = F.col(day) <= F.col("__until")
    if not isinstance(versions.schema[day].dataType, T.DateType):
        due = F.col(day) <= F.col("__until").cast(versions.schema[day].dataType)
    due = F.coalesce(due, F.lit(False))  # no point: nothing is settled
    settled = latest_per_key(dated.where(due).drop("__until"), id_columns, [By(day), *order], ties)
    return snapshot, settled.unionByName(dated.where(~due).drop("__until"))
