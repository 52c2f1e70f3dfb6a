"""AES-256-GCM sealing. Keys travel as scalar subqueries, so no plan, log or UI page
shows them; the sealed value is ``iv(12) | ciphertext | tag(16)``."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitsync.sources.manifest import data_files, relative_file

# Fixed values of the sealed-file format.
KDF_ITERATIONS = 100_000
KEY_BYTES = 32
SALT_BYTES = 16
NONCE_BYTES = 12
TAG_BYTES = 16


def derive_key(password: str, salt: bytes, iterations: int = KDF_ITERATIONS) -> bytes:
    """PBKDF2-HMAC-SHA256; done once per run on the driver."""
    return hashlib.pbkdf2_hmac("sha256", password.encode("utf-8"), salt, iterations, KEY_BYTES)


def new_salt() -> bytes:
    return os.urandom(SALT_BYTES)


def secret_column(spark: SparkSession, value: bytes | str) -> Column:
    """``value`` as a scalar subquery over a one-row frame: plan text shows only its name."""
    kind = "binary" if isinstance(value, bytes) else "string"
    return spark.createDataFrame([(value,)], f"secret {kind}").scalar()


def seal(col: Column, key: Column) -> Column:
    return F.aes_encrypt(col.cast("binary"), key, F.lit("GCM"))


def open_sealed(col: Column, key: Column, strict: bool = False) -> Column:
    """Decrypted bytes. A wrong key or a changed byte gives NULL, or an error if strict."""
    if strict:
        return F.aes_decrypt(col, key, F.lit("GCM"))
    return F.try_aes_decrypt(col, key, F.lit("GCM"))


def seal_rows(df: DataFrame, column: str, key: Column, sealed: str = "sealed") -> DataFrame:
    """Replace ``column`` by its sealed form and the checksum of its plain bytes."""
    plain = F.col(column).cast("binary")
    return df.withColumns({sealed: seal(plain, key), "checksum_sha256": F.sha2(plain, 256)}).drop(column)


def open_rows(df: DataFrame, column: str, key: Column, sealed: str = "sealed") -> DataFrame:
    """Undo ``seal_rows``; ``intact`` is false where key or checksum do not fit."""
    plain = open_sealed(F.col(sealed), key)
    opened = df.withColumn(column, plain)
    intact = F.coalesce(F.sha2(F.col(column), 256) == F.col("checksum_sha256"), F.lit(False))
    return opened.withColumn("intact", intact).drop(sealed)


def seal_files(spark: SparkSession, path: str, password: str, salt: bytes | None = None) -> DataFrame:
    """One row per file under ``path``: ``salt | nonce | ciphertext`` and the checksum.

    Whole files are rows here, so use it on row-bounded chunk files (see
    ``LayoutSpec.max_records``), which is how exports are written.
    """
    salt = salt or new_salt()
    key = secret_column(spark, derive_key(password, salt))
    return data_files(spark, path).select(
        relative_file(spark, path).alias("file"),
        F.concat(F.lit(salt), seal(F.col("content"), key)).alias("sealed"),
        F.sha2("content", 256).alias("checksum_sha256"),
        F.col("length").alias("plain_bytes"),
    ).withColumn("sealed_bytes", F.length("sealed").cast("long"))


def _salted_key(password: str, salt: Column, iterations: int) -> Column:
    """Key column for a salt column. Spark has no PBKDF2, so salts, and only they, go to
    Python in Arrow batches; a task derives the key of a repeated salt once."""
    secret, size = password.encode("utf-8"), KEY_BYTES

    def derive(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # standard library only, so that executors need not have this package
        from hashlib import pbkdf2_hmac

        known: dict = {}
        for salts in batches:
            for value in salts.dropna().unique():
                if value not in known:
                    known[value] = pbkdf2_hmac("sha256", secret, bytes(value), iterations, size)
            yield salts.map(known)

    return F.pandas_udf(derive, "binary")(salt)


def open_files(sealed: DataFrame, password: str, iterations: int = KDF_ITERATIONS) -> DataFrame:
    """Open ``file, sealed, checksum_sha256`` rows; every file may carry its own salt.

    Contents are neither joined nor shuffled, and decryption stays in the JVM.
    """
    key = _salted_key(password, F.expr(f"substring(sealed, 1, {SALT_BYTES})"), iterations)
    body = F.expr(f"substring(sealed, {SALT_BYTES + 1})")
    opened = sealed.withColumn("key", key).withColumn(
        "content", F.try_aes_decrypt(body, F.col("key"), F.lit("GCM"))
    )
    intact = F.sha2("content", 256) == F.col("checksum_sha256")
    return opened.select("file", "content", F.coalesce(intact, F.lit(False)).alias("intact"))
