"""Sealed exports: rows in encrypted, numbered frames of bounded size.

Each task turns its rows into one stream of frames; a frame is some rows as a compressed
Arrow message, sealed with AES-256-GCM. What a frame is called (context, stream, number,
number of rows, whether it is the last of its stream) is authenticated along with it, so
a frame opens only in its own place. A sealed summary says how many streams, frames
and rows there are. No file is ever one value, on either side.

    root/frames   stream, frame, last, rows, sealed
    root/summary  salt, iterations, context, sealed
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.secrets import KDF_ITERATIONS, derive_key, new_salt, secret_column

FRAME_BYTES = 4 * 1024 * 1024
STREAM_STATUSES = ("ok", "unreadable", "repeated", "gap", "cut")
_PLAIN = "stream int, frame int, last boolean, rows long, payload binary"


def _to_frames(frame_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # nested functions only, so that executors need not have this package
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyspark import TaskContext

        stream = TaskContext.get().partitionId()
        options = pa.ipc.IpcWriteOptions(compression="zstd")

        def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows > 1 and batch.nbytes > frame_bytes:
                half = batch.num_rows // 2
                yield from pieces(batch.slice(0, half))
                yield from pieces(batch.slice(half))
            elif batch.num_rows:
                yield batch

        def frame(number: int, last: bool, piece: pa.RecordBatch) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=options) as writer:
                writer.write_batch(piece)
            columns = [pa.array([x], t) for x, t in zip((stream, number, last, piece.num_rows), (pa.int32(), pa.int32(), pa.bool_(), pa.int64()), strict=True)]
            return pa.record_batch([*columns, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["stream", "frame", "last", "rows", "payload"])

        held, number = None, 0
        for batch in batches:
            for piece in pieces(batch):
                if held is not None:
                    yield frame(number, False, held)
                    number += 1
                held = piece
        if held is not None:
            yield frame(number, True, held)

    return run


def _aad(context: str, *parts: Column) -> Column:
    """What is authenticated along with a value; the context's length keeps contexts apart."""
    return F.encode(F.concat_ws("|", F.lit(f"{len(context)}:{context}"), *[p.cast("string") for p in parts]), "utf-8")


def _frame_aad(context: str) -> Column:
    return _aad(context, F.lit("frame"), F.col("stream"), F.col("frame"), F.col("rows"), F.col("last"))


def _opened(sealed: str, key: Column, aad: Column, strict: bool = False) -> Column:
    decrypt = F.aes_decrypt if strict else F.try_aes_decrypt
    return decrypt(F.col(sealed), key, F.lit("GCM"), F.lit("DEFAULT"), aad)


def _sealed(plain: Column, key: Column, aad: Column) -> Column:
    return F.aes_encrypt(plain, key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), aad)


def seal_export(df: DataFrame, root: str, password: str, context: str, frame_bytes: int = FRAME_BYTES) -> dict[str, int]:
    """Write the rows of ``df``, in their partitions and order, below ``root``.

    A frame holds at most ``frame_bytes`` before compression, or one row. Every export has
    a salt, hence a key, of its own, so frames of one never open in another. Returns the
    numbers of streams, frames and rows. A retry replaces what an earlier try has left.
    """
    spark, salt, seen = df.sparkSession, new_salt(), Observation()
    key = secret_column(spark, derive_key(password, salt))
    frames = df.mapInArrow(_to_frames(frame_bytes), _PLAIN)
    sealed = frames.select("stream", "frame", "last", "rows", _sealed(F.col("payload"), key, _frame_aad(context)).alias("sealed"))
    counts = F.count_if("last").alias("streams"), F.count(F.lit(1)).alias("frames"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    writer = sealed.observe(seen, *counts).write.mode("overwrite").option("compression", "uncompressed")
    writer.option("maxRecordsPerFile", max(1, (256 << 20) // frame_bytes)).parquet(f"{root}/frames")
    numbers = {k: int(v) for k, v in seen.get.items()}
    summary = F.encode(F.lit(json.dumps({**numbers, "schema": df.schema.jsonValue()})), "utf-8")
    row = spark.range(1).select(
        F.lit(salt).alias("salt"), F.lit(KDF_ITERATIONS).alias("iterations"), F.lit(context).alias("context"),
        _sealed(summary, key, _aad(context, F.lit("summary"))).alias("sealed"),
    )
    row.write.mode("overwrite").parquet(f"{root}/summary")
    return numbers


class SealedExport:
    """A sealed export opened with a password; a wrong one is an error at once."""

    def __init__(self, spark: SparkSession, root: str, password: str, context: str) -> None:
        self.frames = spark.read.parquet(f"{root}/frames")
        head = spark.read.parquet(f"{root}/summary")
        row = head.first()
        self.context = context
        self.key = secret_column(spark, derive_key(password, bytes(row["salt"]), row["iterations"]))
        text = head.select(_opened("sealed", self.key, _aad(context, F.lit("summary"))).cast("string")).first()[0]
        if text is None:
            raise ValueError(f"{root} does not open as {context}: wrong password, or a changed summary")
        self.summary: dict[str, Any] = json.loads(text)
        self.schema = T.StructType.fromJson(self.summary["schema"])

    def streams(self) -> DataFrame:
        """One row per stream: ``stream, frames, rows, size_bytes, checksum_sha256, status``.

        All frames are decrypted, and none is kept. ``unreadable``: a frame is changed or in
        another's place; ``repeated``, ``gap``, ``cut``: a frame comes twice, is missing
        inside, or the last one is missing.
        """
        intact = _opened("sealed", self.key, _frame_aad(self.context)).isNotNull()
        looked = self.frames.select("stream", "frame", "last", "rows", F.length("sealed").cast("long").alias("size"), F.sha2("sealed", 256).alias("sha"), intact.alias("intact"))
        frames, different, top = F.count(F.lit(1)), F.count_distinct("frame"), F.max("frame") + 1
        status = (
            F.when(F.count_if(~F.col("intact")) > 0, "unreadable")
            .when(frames > different, "repeated")
            .when(different < top, "gap")
            .when(F.count_if("last") == 0, "cut")
            .otherwise("ok")
        )
        listed = F.array_sort(F.collect_list(F.struct("frame", "sha")))
        return looked.groupBy("stream").agg(
            frames.alias("frames"), F.sum("rows").alias("rows"), F.sum("size").alias("size_bytes"),
            F.sha2(F.concat_ws(",", listed["sha"]), 256).alias("checksum_sha256"), status.alias("status"),
        )

    def problems(self, streams: DataFrame | None = None) -> list[str]:
        """What is wrong with the export, the first few streams by name; empty if whole."""
        streams = self.streams() if streams is None else streams
        bad = streams.where("status <> 'ok'").orderBy("stream").limit(5).collect()
        found = [f"stream {r['stream']} is {r['status']}" for r in bad]
        total = streams.agg(F.count(F.lit(1)).alias("streams"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        for what in ("streams", "frames", "rows"):
            if total[what] != self.summary[what]:
                found.append(f"{total[what]} of {self.summary[what]} {what}")
        return found

    def manifest(self, streams: DataFrame) -> DataFrame:
        """The streams in the form of a file manifest."""
        return streams.select(F.concat(F.lit("stream="), "stream").alias("file"), "rows", "size_bytes", "checksum_sha256")

    def read(self, files: DataFrame | None = None) -> DataFrame:
        """The rows, of all streams or of those that a manifest lists. A frame that does not
        open fails the job."""
        frames = self.frames
        if files is not None:
            named = frames.withColumn("__file", F.concat(F.lit("stream="), "stream"))
            frames = named.join(files.select(F.col("file").alias("__file")), "__file", "left_semi")
        payload = frames.select(_opened("sealed", self.key, _frame_aad(self.context), strict=True).alias("payload"))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow as pa

            for batch in batches:
                for value in batch.column("payload"):
                    with pa.ipc.open_stream(value.as_buffer()) as reader:
                        yield from reader

        return payload.mapInArrow(rows, self.schema)
