"""Row filters: composed predicates, membership, high-water mark."""

from __future__ import annotations

import functools
import operator
import re
import warnings
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.functions.names import require

_LEAD = re.compile(r"^\s*(where|and|or)\b\s+", re.IGNORECASE)


def compose(filters: Any) -> Column | None:
    """One predicate from a string, a Column or a list of them.

    Blank items are dropped. Items are AND-ed; one that starts with the word OR opens
    an alternative, with SQL precedence (``a``, ``OR b``, ``c`` is ``a OR (b AND c)``).
    Each item counts as if in parentheses. Anything else warns and filters nothing.
    """
    if filters is None:
        return None
    if isinstance(filters, (str, Column)):
        filters = [filters]
    if not isinstance(filters, (list, tuple)):
        warnings.warn(f"ignoring filters of type {type(filters).__name__}", stacklevel=2)
        return None
    alternatives: list[list[Column]] = [[]]
    for item in filters:
        if isinstance(item, Column):
            alternatives[-1].append(item)
            continue
        text = (item or "").strip()
        if not text:
            continue
        lead = _LEAD.match(text)
        if lead:
            text = text[lead.end():]
            if lead.group(1).lower() == "or" and alternatives[-1]:
                alternatives.append([])
        alternatives[-1].append(F.expr(f"({text})"))
    groups = [functools.reduce(operator.and_, g) for g in alternatives if g]
    return functools.reduce(operator.or_, groups) if groups else None


def apply_filters(df: DataFrame, filters: Any) -> DataFrame:
    predicate = compose(filters)
    return df if predicate is None else df.where(predicate)


def semi_filter(df: DataFrame, members: DataFrame, on: str, member_column: str | None = None) -> DataFrame:
    """Rows whose ``on`` occurs in ``members``; repeated members do not repeat rows.

    No broadcast hint: Catalyst broadcasts members below its size threshold, and AQE
    splits a hot ``on`` value otherwise.
    """
    column = require(members, member_column or on)
    keys = members.select(F.col(column).alias("__member"))
    return df.join(keys, df[require(df, on)] == keys["__member"], "left_semi")


def share_keys(df: DataFrame, some: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``some``; NULL keys match NULL keys."""
    wanted = some.select(*[F.col(require(some, k)).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[require(df, k)].eqNullSafe(wanted[f"__k{i}"])
    return df.join(wanted, cond, "left_semi")


def since(
    df: DataFrame,
    column: str,
    mark: Any,
    full_reload: bool = False,
    point: str | None = None,
    point_mark: Any = None,
) -> DataFrame:
    """Rows strictly above the stored mark; no mark or a full reload keeps all rows.

    ``mark`` is a literal (pushed into the scan) or a one-row DataFrame (a scalar
    subquery, so that the plan needs no driver round trip; an empty one or a NULL keeps
    all rows). For snapshots, ``point`` and ``point_mark`` also keep rows of spine
    points after the last one delivered: an old version may be due at a new point.
    """
    if full_reload or mark is None:
        return df
    name = require(df, column)
    dtype = df.schema[name].dataType
    if isinstance(mark, DataFrame):
        scalar = mark.select(F.col(mark.columns[0]).cast(dtype)).scalar()
        keep = scalar.isNull() | (F.col(name) > scalar)
    else:
        keep = F.col(name) > F.lit(mark).cast(dtype)
    if point is not None and point_mark is not None:
        where = require(df, point)
        keep = keep | (F.col(where) > F.lit(point_mark).cast(df.schema[where].dataType))
    return df.where(keep)
