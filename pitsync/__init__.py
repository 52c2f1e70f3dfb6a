"""Point-in-time reads and table synchronisation as Spark plans."""

from pitsync.functions.ordering import By
from pitsync.operators.dedupe import duplicate_keys, keep_last, latest_n_per_key, latest_per_key
from pitsync.operators.merge import append, full_load, upsert
from pitsync.operators.snapshots import distinct_points, month_ends, snapshot_asof, snapshot_valid
from pitsync.plans.extract import plan_extract
from pitsync.spec import Members, Snapshot, TableSpec, Unpack, load_specs, spec_from_dict

__all__ = [
    "By",
    "Members",
    "Snapshot",
    "TableSpec",
    "Unpack",
    "append",
    "distinct_points",
    "duplicate_keys",
    "full_load",
    "keep_last",
    "latest_n_per_key",
    "latest_per_key",
    "load_specs",
    "month_ends",
    "plan_extract",
    "snapshot_asof",
    "snapshot_valid",
    "spec_from_dict",
    "upsert",
]
