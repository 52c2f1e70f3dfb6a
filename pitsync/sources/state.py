"""Sync state and load checkpoints as append-only tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitsync.functions.ordering import By
from pitsync.operators.dedupe import latest_n_per_key, latest_per_key
from pitsync.sources.sinks import append_rows, claim, read_log

STATE = (
    "table_name string, watermark_value string, rows_exported long, "
    "updated_at timestamp_ntz, run_id string, is_reset boolean, version long"
)
LOADED = "table_name string, run_id string, file string, checksum_sha256 string"
HISTORY_KEPT = 10


def current_marks(
    state: DataFrame, table: str = "table_name", at: str = "updated_at", ties: Sequence[Any] | None = None
) -> DataFrame:
    """Latest state row per table; a table whose latest row is a reset has none."""
    newest = latest_per_key(state, [table], [By(at, nulls_first=False)], ties)
    return newest.where(~F.coalesce(F.col("is_reset"), F.lit(False)))


def mark_history(
    state: DataFrame,
    table: str = "table_name",
    at: str = "updated_at",
    kept: int = HISTORY_KEPT,
    ties: Sequence[Any] | None = None,
) -> DataFrame:
    """The current mark (``age`` 0) and up to ``kept`` earlier ones per table."""
    order = [By(at, nulls_first=False)]
    ranked = latest_n_per_key(state, [table], order, kept + 1, ties, rank_column="age")
    return ranked.withColumn("age", (F.col("age") - 1).cast("int"))


def pending_files(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Manifest rows not loaded yet. The checksum is part of the key: a newer export
    that reuses a file name counts as new work."""
    keys = ["table_name", "run_id", "file", "checksum_sha256"]
    return manifest.join(loaded.select(*keys), keys, "left_anti")


def table_folder(path: str, table: str) -> str:
    """Each table appends to its own folder: tables load side by side, and two jobs
    committing into one folder would remove each other's temporary files."""
    return f"{path}/{quote(table, safe='')}"


@dataclass(frozen=True)
class SyncState:
    """High-water marks of all tables under one path."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        return read_log(self.spark, self.path, STATE)

    def current(self) -> DataFrame:
        return current_marks(self.rows(), at="version")

    def history(self, kept: int = HISTORY_KEPT) -> DataFrame:
        return mark_history(self.rows().where(~F.col("is_reset")), at="version", kept=kept)

    def _last(self, table: str) -> Any | None:
        mine = read_log(self.spark, table_folder(self.path, table), STATE)
        return mine.orderBy(F.desc("version")).limit(1).first()

    def get(self, table: str) -> str | None:
        """The stored mark: one value, so that it can be pushed into the scan."""
        row = self._last(table)
        return None if row is None or row["is_reset"] else row["watermark_value"]

    def _append(self, table: str, value: str | None, rows: int | None, at: Any, run_id: str, reset: bool) -> None:
        last = self._last(table)
        version = 1 if last is None else last["version"] + 1
        claim(self.spark, f"{table_folder(self.path, table)}/_versions", version)
        row = (table, value, rows, at, run_id, reset, version)
        append_rows(self.spark, table_folder(self.path, table), STATE, [row])

    def update(
        self, table: str, value: str, rows: int, at: Any, run_id: str, as_type: str | None = None
    ) -> bool:
        """Append a mark. With ``as_type`` it may only rise: a lower value is refused."""
        if as_type:
            old = self.get(table)
            if old is not None:
                higher = self.spark.range(1).select(
                    (F.lit(value).cast(as_type) >= F.lit(old).cast(as_type)).alias("ok")
                )
                if not higher.first()["ok"]:
                    return False
        self._append(table, value, rows, at, run_id, False)
        return True

    def reset(self, table: str, at: Any, run_id: str) -> None:
        self._append(table, None, None, at, run_id, True)


@dataclass(frozen=True)
class LoadCheckpoint:
    """Which files of which run are in the target already."""

    spark: SparkSession
    path: str

    def loaded(self, table: str | None = None) -> DataFrame:
        """What is loaded, of all tables or of one, whose folder alone is read then."""
        return read_log(self.spark, table_folder(self.path, table) if table else self.path, LOADED)

    def mark(self, table: str, files: DataFrame) -> None:
        keys = ["table_name", "run_id", "file", "checksum_sha256"]
        files.select(*keys).write.mode("append").parquet(table_folder(self.path, table))
