"""Table specifications: what to read, how to reduce it, how to apply it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

SYNC_MODES = ("full", "incremental", "upsert")
SNAPSHOT_KINDS = ("valid", "asof")


@dataclass(frozen=True)
class Members:
    """Keep rows whose ``on`` occurs in ``column`` of table ``table``."""

    table: str
    column: str
    on: str


@dataclass(frozen=True)
class Snapshot:
    """A point-in-time join against the distinct dates of a spine table.

    ``valid``: versions with ``start < point <= end``.
    ``asof``:  the version with the greatest ``date <= point``.
    """

    kind: str
    spine_table: str
    spine_column: str
    id: tuple[str, ...]
    point: str
    start: str | None = None
    end: str | None = None
    date: str | None = None
    ties: tuple[str, ...] = ()
    #: False if versions of an id are known not to overlap ('valid' only)
    overlapping: bool = True

    def __post_init__(self) -> None:
        if self.kind not in SNAPSHOT_KINDS:
            raise ValueError(f"snapshot kind must be one of {SNAPSHOT_KINDS}, not {self.kind!r}")
        if self.kind == "valid" and not (self.start and self.end):
            raise ValueError("a 'valid' snapshot needs start and end columns")
        if self.kind == "asof" and not self.date:
            raise ValueError("an 'asof' snapshot needs a date column")


@dataclass(frozen=True)
class Unpack:
    """Typed fields of a JSON or variant column: ``{path: (name, type)}``."""

    column: str
    fields: dict[str, tuple[str, str]]
    keep: tuple[str, ...] = ()
    strict: bool = False


#: Fixed value: the version-end column of the sources.
DEFAULT_ORDER = "_TIMESTAMPTO"


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str
    sync_mode: str = "full"
    merge_keys: tuple[str, ...] = ()
    watermark: str | None = None
    #: the column that ranks the rows of a key; only the default may be absent from a table
    order_by: str = DEFAULT_ORDER
    ties: tuple[str, ...] = ()
    filters: tuple[Any, ...] = ()
    members: Members | None = None
    derive: dict[str, str] = field(default_factory=dict)
    unpack: Unpack | None = None
    snapshot: Snapshot | None = None
    source_query: str | None = None
    #: the source query is already one row per key: filter and mark apply outside it
    source_is_deduplicated: bool = False
    index_columns: tuple[str, ...] = ()
    rules: dict[str, dict[str, Any]] = field(default_factory=dict)
    target: str | None = None
    partition_by: tuple[str, ...] = ()
    #: keep the target in so many hash buckets of its merge keys, so that an upsert reads and
    #: rewrites only the buckets its keys fall into; a target refuses another number
    buckets: int = 0
    #: how an unpartitioned target is merged, see ``operators.merge.upsert``
    upsert_strategy: str = "outer"
    #: count keys of the whole target after each upsert; a full shuffle of it
    verify_keys: bool = False

    def __post_init__(self) -> None:
        if self.sync_mode not in SYNC_MODES:
            raise ValueError(f"sync_mode must be one of {SYNC_MODES}, not {self.sync_mode!r}")
        if self.sync_mode == "upsert" and not self.merge_keys:
            raise ValueError(f"{self.name}: upsert needs merge_keys")
        if self.buckets < 0 or self.buckets and self.sync_mode != "upsert":
            raise ValueError(f"{self.name}: buckets are a number of them, for upserts")

    @property
    def phase(self) -> str:
        """Whether filters run before or after the reduction to one row per key."""
        reduced = self.snapshot is not None or self.source_is_deduplicated
        return "dedup_then_filter" if reduced else "filter_then_dedup"

    @property
    def sort_keys(self) -> tuple[str, ...]:
        """Merge keys, then the watermark column if it is not one of them."""
        keys = list(self.merge_keys)
        if self.watermark and self.watermark.lower() not in {k.lower() for k in keys}:
            keys.append(self.watermark)
        return tuple(keys)

    def with_(self, **changes: Any) -> TableSpec:
        return replace(self, **changes)


def spec_from_dict(entry: dict[str, Any], defaults: dict[str, Any] | None = None) -> TableSpec:
    """Build a spec from a plain mapping (one config entry); ``defaults`` fill gaps."""
    values = {**(defaults or {}), **entry}
    values.setdefault("source", values["name"])
    for key in ("merge_keys", "ties", "index_columns", "partition_by"):
        if key in values:
            values[key] = tuple(values[key])
    if isinstance(values.get("filters"), str):
        values["filters"] = (values["filters"],)
    elif "filters" in values:
        values["filters"] = tuple(values["filters"])
    if isinstance(values.get("members"), dict):
        values["members"] = Members(**values["members"])
    if isinstance(values.get("snapshot"), dict):
        snap = dict(values["snapshot"])
        for key in ("id", "ties"):
            if key in snap:
                snap[key] = (snap[key],) if isinstance(snap[key], str) else tuple(snap[key])
        values["snapshot"] = Snapshot(**snap)
    if isinstance(values.get("unpack"), dict):
        unpack = dict(values["unpack"])
        unpack["fields"] = {p: tuple(v) for p, v in unpack["fields"].items()}
        unpack["keep"] = tuple(unpack.get("keep", ()))
        values["unpack"] = Unpack(**unpack)
    return TableSpec(**values)


def load_specs(path: str) -> list[TableSpec]:
    """Read specs from a JSON file, or from YAML where PyYAML is installed.

    The file holds ``{"defaults": {...}, "tables": [{...}, ...]}``.
    """
    with open(path, encoding="utf-8") as handle:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as err:
                raise RuntimeError("YAML specs need PyYAML; use JSON instead") from err
            config = yaml.safe_load(handle)
        else:
            config = json.load(handle)
    return [spec_from_dict(entry, config.get("defaults")) for entry in config["tables"]]
