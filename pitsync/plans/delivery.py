"""Loading what a delivery lists: tables, modes and keys come with the data."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Row

from pitsync.plans.sync import Workspace, import_table, run_tables
from pitsync.spec import TableSpec


def listed_spec(entry: Row, known: TableSpec | None = None) -> TableSpec:
    """The spec of one listed table. Mode, keys, mark and target of the listing win over
    those of a known spec, where it has any; all else, such as rules, is the known one's."""
    found = entry.asDict()
    keys = found.get("merge_keys")
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",") if k.strip()]
    given = {
        "sync_mode": found.get("sync_mode"),
        "merge_keys": tuple(keys or ()),
        "watermark": found.get("watermark_column"),
        "target": found.get("target"),
    }
    given = {k: v for k, v in given.items() if v}
    return known.with_(**given) if known else TableSpec(found["name"], found["name"], **given)


def import_listing(
    ws: Workspace,
    listing: DataFrame,
    run_id: str,
    known: Sequence[TableSpec] = (),
    only: str | None = None,
    parallel: int = 1,
    **options: Any,
) -> list[dict[str, Any]]:
    """Import every table of a listing (see ``operators.audit.delivery_listing``), or one.

    A listing has a row per table, so it is read by the driver. A table that is listed
    twice is an error; one that cannot be loaded, or whose entry makes no spec, is logged
    as failed and does not stop the others. ``options`` go to ``import_table``.
    """
    entries = {r["name"].lower(): r for r in listing.collect()}
    if len(entries) != listing.count():
        raise ValueError("a table is listed twice")
    specs = {s.name.lower(): s for s in known}

    def load(spec: TableSpec) -> dict[str, Any]:
        name = spec.name.lower()
        return import_table(ws, listed_spec(entries[name], specs.get(name)), run_id, **options)

    named = [TableSpec(r["name"], r["name"]) for _, r in sorted(entries.items())]
    return run_tables(ws, named, load, run_id, "import", only, parallel)
