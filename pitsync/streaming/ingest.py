"""Resumable file ingest and streaming upserts."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitsync.functions.ordering import By
from pitsync.operators.dedupe import latest_per_key
from pitsync.operators.project import stamp
from pitsync.operators.merge import BUCKET, bucket_of, reject_null_keys, upsert
from pitsync.sources.sinks import LayoutSpec, PartitionedTable, SnapshotTable, upsert_partitions


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; each file is delivered once."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all files that have arrived, then stop. The checkpoint remembers them, and
    the sink's log makes a batch repeated after a crash count once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_batch(
    table: SnapshotTable,
    keys: Sequence[str],
    order: Sequence[str],
    run_ts: Callable[[int], Any],
    layout: LayoutSpec | None = None,
    stream_id: str | Callable[[], str] = "stream",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts each micro-batch into a snapshot table.

    ``stream_id`` and the batch id name the snapshot, so a batch delivered again after it
    was published is recognised and skipped, and batches of another stream, or of the same
    one under a new checkpoint, are not taken for it. Streams into one table need ids of
    their own. A NULL key fails the batch.
    """
    layout = layout or LayoutSpec(sort_keys=tuple(keys))

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id() if callable(stream_id) else stream_id
        run_id = f"{stream}-batch-{batch_id:012d}"
        if table.is_published(run_id):
            return
        reduced = latest_per_key(reject_null_keys(batch, keys), keys, [By(c) for c in order])
        old = table.read()
        at = run_ts(batch_id)
        result = stamp(reduced, at) if old is None else upsert(old, reduced, keys, run_ts=at, deduplicated=True)
        _, rows = table.write(result, run_id, layout)
        table.publish(run_id, rows, at)

    return apply


def bucketed_batch(
    table: PartitionedTable,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int,
    stage: str,
    run_ts: Callable[[int], Any] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts into the key buckets that a micro-batch
    touches. A batch delivered again gives the same content."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn(BUCKET, bucket_of(keys, buckets))
        layout = LayoutSpec(sort_keys=tuple(keys))
        at = run_ts(batch_id) if run_ts else None
        upsert_partitions(table, placed, keys, [By(c) for c in order], [BUCKET], f"{stage}/{batch_id}", layout, at, buckets=buckets)

    return apply


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it first used ``checkpoint``."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def upsert_stream(
    stream: DataFrame, table: SnapshotTable, keys: Sequence[str], order: Sequence[str], checkpoint: str,
    run_ts: Callable[[int], Any],
) -> None:
    """Upsert all files that have arrived, micro-batch by micro-batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(
            upsert_batch(table, keys, order, run_ts, stream_id=lambda: checkpoint_id(table.spark, checkpoint))
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
