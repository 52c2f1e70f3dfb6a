"""Case-insensitive column lookup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def find(df: DataFrame, name: str) -> str | None:
    """The spelling ``df`` uses for ``name``, or None."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def require(df: DataFrame, name: str) -> str:
    found = find(df, name)
    if found is None:
        raise ValueError(f"column {name!r} not found among {df.columns}")
    return found


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in its spelling; others are left out."""
    return [c for c in (find(df, n) for n in names) if c is not None]


def unused(name: str, df: DataFrame) -> str:
    """``name``, or a longer one until no column of ``df`` begins with it in any case."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name
