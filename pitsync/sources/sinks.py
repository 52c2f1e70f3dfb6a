"""Writing: tuned Parquet layouts and snapshot tables."""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.curve import with_curve_key
from pitsync.functions.names import present, unused
from pitsync.functions.ordering import content_tiebreak
from pitsync.operators.dedupe import latest_per_key
from pitsync.operators.merge import changed_partitions, reject_null_keys, upsert
from pitsync.operators.project import merge_schema, stamp

CLUSTERINGS = ("sort", "range", "curve", "none")
# The names Hadoop gives to gzip levels 1 to 9.
GZIP_LEVELS = ("BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION")

#: A page ends by its bytes alone. Parquet's own bound of 20,000 rows makes pages of narrow columns so
#: small that a codec, which starts anew with each page, spends most of its time on starting.
PAGE_ROWS = 2**31 - 1
LEVELS = {"gzip": (1, 9), "zstd": (1, 22), "brotli": (0, 11)}


@dataclass(frozen=True)
class LayoutSpec:
    """How files are written.

    ``sort`` orders rows inside each task's files without a shuffle; ``range`` also
    spreads them by key over the whole output, so that readers skip row groups; ``curve``
    does so by a space-filling key over all sort keys, so that filters on any of them skip;
    ``none`` keeps rows as they come. ``max_records`` bounds a file, as checksums and sealing take
    a file as one value. Rows of a Hive partition that ``lie_together`` already are written without
    a shuffle.
    """

    sort_keys: tuple[str, ...] = ()
    clustering: str = "sort"
    compression: str = "zstd"
    level: int | None = 3
    page_bytes: int = 1024 * 1024
    max_records: int = 500_000
    dictionary: tuple[str, ...] | None = None
    partition_by: tuple[str, ...] = ()
    lie_together: bool = False

    def __post_init__(self) -> None:
        if self.clustering not in CLUSTERINGS:
            raise ValueError(f"clustering must be one of {CLUSTERINGS}")
        low, high = LEVELS.get(self.compression, (None, None))
        if self.level is not None and low is not None and not low <= self.level <= high:
            raise ValueError(f"{self.compression} has levels {low} to {high}, not {self.level}")


def arrange(df: DataFrame, layout: LayoutSpec) -> DataFrame:
    """Partition and sort ``df`` for a layout. Sort keys the frame lacks are left out.

    Hive partitions use REBALANCE, which lets AQE split a hot partition over several
    tasks and join small ones. Range clustering ends its keys with a row hash, so equal
    keys, however many, still spread over partitions. A curve costs one more pass over its
    columns, which finds their quantiles.
    """
    keys = present(df, layout.sort_keys)
    parts = present(df, layout.partition_by)
    if keys and layout.clustering == "curve":
        place = unused("curve_key", df)
        placed = with_curve_key(df, keys, place)
        if parts and not layout.lie_together:
            placed = placed.hint("rebalance", *[F.col(p) for p in parts])
        elif not parts:
            placed = placed.repartitionByRange(place, content_tiebreak(df))
        return placed.sortWithinPartitions(*parts, place).drop(place)
    if parts and not layout.lie_together:
        df = df.hint("rebalance", *[F.col(p) for p in parts])
    elif not parts and keys and layout.clustering == "range":
        df = df.repartitionByRange(*[F.col(k) for k in keys], content_tiebreak(df))
    order = parts + [k for k in keys if k not in parts]
    return df.sortWithinPartitions(*order) if order and layout.clustering != "none" else df


def write_layout(
    df: DataFrame,
    path: str,
    layout: LayoutSpec = LayoutSpec(),
    mode: str = "errorifexists",
    partition_overwrite: str = "static",
    metrics: Sequence[Column] = (),
) -> dict[str, Any]:
    """Write ``df`` in a layout. By default an overwrite keeps no partition of an earlier
    try, whatever the session says.

    ``metrics`` are aggregates, gathered while the rows are written and returned by name.
    They are taken where rows leave for the files: below a range shuffle its sampling
    would count them twice.
    """
    seen, arranged = Observation(), arrange(df, layout)
    if metrics:
        arranged = arranged.observe(seen, *metrics)
    writer = (
        arranged.write.mode(mode)
        .option("compression", layout.compression)
        .option("parquet.page.size", str(layout.page_bytes))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("maxRecordsPerFile", layout.max_records)
        .option("partitionOverwriteMode", partition_overwrite)
    )
    if layout.level is not None and layout.compression == "gzip":
        writer = writer.option("zlib.compress.level", GZIP_LEVELS[layout.level - 1])
    elif layout.level is not None and layout.compression == "zstd":
        writer = writer.option("parquet.compression.codec.zstd.level", str(layout.level))
    elif layout.level is not None and layout.compression == "brotli":
        writer = writer.option("compression.brotli.quality", str(layout.level))
    if layout.dictionary is not None:
        writer = writer.option("parquet.enable.dictionary", "false")
        for column in present(df, layout.dictionary):
            writer = writer.option(f"parquet.enable.dictionary#{column}", "true")
    if layout.partition_by:
        writer = writer.partitionBy(*present(df, layout.partition_by))
    writer.parquet(path)
    return dict(seen.get) if metrics else {}


def append_rows(spark: SparkSession, path: str, schema: str, rows: Sequence[tuple[Any, ...]]) -> None:
    """Add a few bookkeeping rows as one file, which appears at once or not at all."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def claim(spark: SparkSession, path: str, version: int) -> None:
    """Take a version number, or fail if another writer has: of two writers that saw the
    same last version, one gets the marker file and the other an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_version_{version:012d}")
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(place.getParent())
    if not files.createNewFile(place):
        raise RuntimeError(f"version {version} of {path} is taken by another writer")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A bookkeeping table; one that was never written is empty."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as err:
        if not is_missing(err):
            raise
        return spark.createDataFrame([], schema)


def is_missing(err: AnalysisException) -> bool:
    """Whether a read failed because nothing is there. Any other reason must surface: a
    log taken for empty would load everything again."""
    return err.getCondition() == "PATH_NOT_FOUND"


COMMITS = (
    "run_id string, version long, path string, row_count long, committed_at timestamp_ntz, is_append boolean, "
    "schema string"
)


@dataclass(frozen=True)
class SnapshotTable:
    """A target table: immutable folders and a log that says which of them count.

    A load reads the current content and writes a new folder, never the one it reads.
    ``publish`` then appends one log row; until that moment readers see the old content,
    and a failed or repeated load leaves nothing half done. A folder published as an
    append adds to what came before, so appending never rewrites a table; any other
    replaces it.
    """

    spark: SparkSession
    root: str

    @property
    def commits_path(self) -> str:
        return f"{self.root}/commits"

    def commits(self) -> DataFrame:
        return read_log(self.spark, self.commits_path, COMMITS)

    def latest(self) -> Any | None:
        """The current log row, or None for a table without one."""
        return self.commits().orderBy(F.desc("version")).limit(1).first()

    def current(self) -> DataFrame:
        """The log rows of the folders that make up the table: the last replacing one and
        later appends."""
        log = self.commits()
        base = log.where(~F.col("is_append")).agg(F.max("version").alias("v")).scalar()
        return log.where(F.col("version") >= F.coalesce(base, F.lit(0)))

    def current_paths(self) -> list[str]:
        return [row["path"] for row in self.current().orderBy("version").select("path").toLocalIterator()]

    def read(self) -> DataFrame | None:
        """All current folders in one read, under the merged schema of the log's entries.

        Folders written before a column was added give NULLs for it; widened columns are
        widened while they are read. No footer is opened for a schema.
        """
        rows = self.current().orderBy("version").select("path", "schema").collect()
        if not rows:
            return None
        schemas = list(dict.fromkeys(row["schema"] for row in rows))
        merged = functools.reduce(merge_schema, [T.StructType.fromJson(json.loads(s)) for s in schemas])
        return self.spark.read.schema(merged).parquet(*[row["path"] for row in rows])

    def snapshot_path(self, run_id: str) -> str:
        return f"{self.root}/snapshot={run_id}"

    def is_published(self, run_id: str) -> bool:
        return self.commits().where(F.col("run_id") == run_id).limit(1).first() is not None

    def write(self, df: DataFrame, run_id: str, layout: LayoutSpec = LayoutSpec()) -> tuple[DataFrame, int]:
        """Write a folder and read it back, with the number of rows written; it does not
        count until published. A retry of the same run replaces its own unpublished folder."""
        if self.is_published(run_id):
            raise ValueError(f"run {run_id} is already published")
        path = self.snapshot_path(run_id)
        seen = write_layout(df, path, layout, mode="overwrite", metrics=[F.count(F.lit(1)).alias("rows")])
        return self.spark.read.parquet(path), seen["rows"]

    def publish(self, run_id: str, row_count: int, committed_at: Any, is_append: bool = False) -> None:
        last = self.latest()
        version = 1 if last is None else last["version"] + 1
        claim(self.spark, f"{self.root}/versions", version)
        schema = self.spark.read.parquet(self.snapshot_path(run_id)).schema.json()
        row = (run_id, version, self.snapshot_path(run_id), row_count, committed_at, is_append, schema)
        append_rows(self.spark, self.commits_path, COMMITS, [row])


SCHEMAS = "version long, schema string, buckets int"


@dataclass(frozen=True)
class PartitionedTable:
    """A target in Hive partitions, for upserts that touch few of them.

    Its schema is kept in a log, so that reading needs no merge of file footers and files
    written before a column was added or widened still fit.
    """

    spark: SparkSession
    root: str

    @property
    def path(self) -> str:
        return f"{self.root}/partitions"

    def _last(self) -> Any | None:
        log = read_log(self.spark, f"{self.root}/schemas", SCHEMAS)
        return log.orderBy(F.desc("version")).limit(1).first()

    def schema(self) -> T.StructType | None:
        row = self._last()
        return None if row is None else T.StructType.fromJson(json.loads(row["schema"]))

    def set_schema(self, schema: T.StructType, buckets: int | None = None) -> None:
        """Record a schema, and the number of buckets; do so before writing data in it."""
        last = self._last()
        if last is not None and schema == self.schema() and buckets == last["buckets"]:
            return
        version = 1 if last is None else last["version"] + 1
        claim(self.spark, f"{self.root}/versions", version)
        append_rows(self.spark, f"{self.root}/schemas", SCHEMAS, [(version, schema.json(), buckets)])

    def check_buckets(self, buckets: int | None) -> None:
        """Refuse another number of buckets than the table's: its rows would not be found again."""
        last = self._last()
        if last is not None and last["buckets"] != buckets:
            raise ValueError(f"{self.root} has {last['buckets']} key buckets, not {buckets}; load it afresh to change that")

    def read(self) -> DataFrame | None:
        schema = self.schema()
        if schema is None:
            return None
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as err:
            if not is_missing(err):
                raise
            return None  # the first load stopped before any data was written


def overwrite_partitions(df: DataFrame, path: str, stage: str, layout: LayoutSpec) -> None:
    """Replace just the partitions that ``df`` has rows for.

    Rows are staged first, since they usually derive from the partitions about to be
    replaced; other partitions are neither read nor written.
    """
    if not layout.partition_by:
        raise ValueError("overwrite_partitions needs partition columns")
    write_layout(df, stage, layout, mode="overwrite")
    staged = df.sparkSession.read.schema(df.schema).parquet(stage)
    write_layout(staged, path, layout, "overwrite", "dynamic")


def upsert_partitions(
    table: PartitionedTable,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Any],
    parts: Sequence[str],
    stage: str,
    layout: LayoutSpec = LayoutSpec(),
    run_ts: Any = None,
    fresh: bool = False,
    buckets: int | None = None,
) -> int:
    """Upsert into the partitions that the batch touches; returns the rows of the batch.

    ``buckets`` says how many key buckets the partition values come from, if they do; a
    table keeps the number of its first load.

    The batch is reduced and staged once, and what is read and written otherwise is the
    touched partitions. Folders are replaced one by one, so a reader may meet some new and
    some old partitions; a load that stopped half way is repeated as a whole, which gives
    the same content.
    """
    spark, layout = table.spark, replace(layout, partition_by=tuple(parts))
    if not fresh:
        table.check_buckets(buckets)
    reduced = latest_per_key(reject_null_keys(batch, keys), keys, order)
    seen = write_layout(reduced, f"{stage}/batch", LayoutSpec(), "overwrite", metrics=[F.count(F.lit(1)).alias("rows")])
    staged = spark.read.parquet(f"{stage}/batch")
    old = None if fresh else table.read()
    if old is None:
        result = staged if run_ts is None else stamp(staged, run_ts)
        table.set_schema(result.schema, buckets)
        write_layout(result, table.path, layout, "overwrite")
    else:
        result = upsert(changed_partitions(old, staged, parts), staged, keys, run_ts=run_ts, deduplicated=True)
        table.set_schema(result.schema, buckets)
        overwrite_partitions(result, table.path, f"{stage}/result", layout)
    return seen["rows"]
