"""Order specifications with explicit null placement, and tie-breakers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.functions.hashing import hash_inputs


@dataclass(frozen=True)
class By:
    """One order key. The default, descending with NULLs first, lets an open-ended
    (NULL) version win a latest-per-key selection."""

    column: str
    descending: bool = True
    nulls_first: bool = True

    def to_column(self) -> Column:
        col = F.col(self.column)
        if self.descending:
            return col.desc_nulls_first() if self.nulls_first else col.desc_nulls_last()
        return col.asc_nulls_first() if self.nulls_first else col.asc_nulls_last()


OrderKey = str | By | Column


def order_columns(order: Sequence[OrderKey]) -> list[Column]:
    """A plain string means descending, NULLs first."""
    out = []
    for key in order:
        if isinstance(key, str):
            key = By(key)
        out.append(key.to_column() if isinstance(key, By) else key)
    return out


def content_tiebreak(df: DataFrame) -> Column:
    """A hash of the whole row. As the last order key it makes a selection repeatable,
    so a task rerun after a lost executor picks the same row again."""
    return F.xxhash64(*hash_inputs(df.schema.fields)).desc()
