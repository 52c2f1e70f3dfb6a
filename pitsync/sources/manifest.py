"""File manifests: what was written, and whether it is still so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitsync.functions.hashing import multiset_digest, no_rows_digest, row_words

MANIFEST = "file string, rows long, size_bytes long, checksum_sha256 string"


def relative_file(spark: SparkSession, root: str) -> Column:
    """The file of a row, as a path below ``root``.

    ``_metadata.file_path`` is an encoded URI in every kind of read, so the root is
    encoded in the same way and all names agree, whatever characters they hold.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(root)
    uri = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toUri()
    below = F.lit(uri.getRawPath().rstrip("/") + "/")
    path = F.col("_metadata.file_path")
    return F.substring(path, F.locate(uri.getRawPath().rstrip("/") + "/", path) + F.length(below), F.length(path))


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files below ``path``, one row each."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """``file, size_bytes`` of the Parquet files below ``path``; contents are not read."""
    return data_files(spark, path).select(relative_file(spark, path).alias("file"), F.col("length").alias("size_bytes"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the Parquet files below ``path``."""
    total = file_listing(spark, path).agg(F.sum("size_bytes").alias("b")).first()
    return int(total["b"] or 0)


def manifest(spark: SparkSession, path: str, checksum: str = "file") -> DataFrame:
    """One row per file: ``file, rows, size_bytes, checksum_sha256``.

    ``file`` is the path below ``path`` in the encoded form of a URI.
    ``file`` hashes each file's bytes and suits row-bounded chunk files, as a file is one
    value there. ``rows`` hashes the rows of each file instead: no size limit, partial
    aggregation, and equal contents agree even if encoded differently. A file without rows,
    as Spark writes one for an empty first task, has the digest of no rows.
    """
    if checksum not in ("file", "rows"):
        raise ValueError("checksum is 'file' or 'rows'")
    data = spark.read.parquet(path)
    name = relative_file(spark, path).alias("file")
    counted = data.select(name).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    if checksum == "file":
        files = data_files(spark, path).select(
            name,
            F.col("length").alias("size_bytes"),
            F.sha2("content", 256).alias("checksum_sha256"),
        )
        joined = files.join(counted, "file", "left")
    else:
        digests = (
            data.select(name, *[w.alias(f"__w{i}") for i, w in enumerate(row_words(data.schema))])
            .groupBy("file")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                multiset_digest([F.col("__w0"), F.col("__w1")]).alias("checksum_sha256"),
            )
        )
        joined = file_listing(spark, path).join(digests, "file", "left")
        joined = joined.withColumn("checksum_sha256", F.coalesce("checksum_sha256", no_rows_digest()))
    return joined.select(
        "file", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "size_bytes", "checksum_sha256"
    )


def only_files(data: DataFrame, path: str, files: DataFrame) -> DataFrame:
    """Rows of a Parquet frame that come from the listed files."""
    named = data.withColumn("__file", relative_file(data.sparkSession, path))
    return named.join(files.select(F.col("file").alias("__file")), "__file", "left_semi").drop("__file")


def manifest_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("total_size_bytes"),
    )


def verify(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Status per file: ok, mismatch, missing (listed only) or unlisted (present only).
    Numbers of rows must agree as well as checksums, where both sides have them."""
    rows = F.col("rows") if "rows" in expected.columns and "rows" in actual.columns else F.lit(0)
    e = expected.select("file", F.struct("checksum_sha256", rows.alias("rows")).alias("__e"), F.lit(True).alias("__listed"))
    a = actual.select("file", F.struct("checksum_sha256", rows.alias("rows")).alias("__a"), F.lit(True).alias("__there"))
    status = (
        F.when(F.col("__there").isNull(), F.lit("missing"))
        .when(F.col("__listed").isNull(), F.lit("unlisted"))
        .when(F.col("__e").eqNullSafe(F.col("__a")) & F.col("__e.checksum_sha256").isNotNull(), F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return e.join(a, "file", "full_outer").select("file", status.alias("status"))


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    data = spark.read.parquet(path).select(relative_file(spark, path).alias("file"))
    return data.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
