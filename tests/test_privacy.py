from __future__ import annotations

import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitsync.functions.hashing import chunk_file_id, keyed_id, metadata_file_id, table_folder_id
from pitsync.functions.secrets import (
    derive_key,
    open_files,
    open_rows,
    open_sealed,
    seal,
    seal_files,
    seal_rows,
    secret_column,
)
from tests.conftest import plan_of

SALT = bytes(range(16))


def ident(text, length=16):
    return hashlib.sha256(text.encode()).hexdigest()[:length]


def test_identifiers(spark):
    df = spark.createDataFrame([("Tbl", 7), (None, 8)], "t string, n int")
    row = df.select(
        table_folder_id(F.col("t"), "s").alias("folder"),
        chunk_file_id(F.col("t"), F.col("n"), "s").alias("chunk"),
        metadata_file_id(F.col("t"), "ddl").alias("ddl"),
        metadata_file_id(F.col("t"), "ddl", F.lit("20240131"), "s").alias("old"),
        keyed_id(F.col("n"), "ctx", length=8).alias("short"),
    ).collect()
    assert row[0].asDict() == {
        "folder": ident("s:Tbl:folder"),
        "chunk": ident("s:Tbl:chunk:7:data"),
        "ddl": ident(":Tbl:ddl"),
        "old": ident("s:Tbl:ddl:20240131:"),
        "short": ident(":7:ctx", 8),
    }
    assert row[1]["folder"] is None


def test_key_derivation_is_pbkdf2():
    assert derive_key("pw", SALT) == hashlib.pbkdf2_hmac("sha256", b"pw", SALT, 100_000, 32)


def test_round_trip_and_layout(spark):
    key = secret_column(spark, derive_key("pw", SALT, 10))
    df = spark.createDataFrame([("hello",), ("",), (None,)], "v string")
    sealed = df.select("v", seal(F.col("v"), key).alias("s"))
    got = sealed.select("v", F.length("s").alias("n"), open_sealed(F.col("s"), key).cast("string").alias("o")).collect()
    assert [(r["v"], r["o"]) for r in got] == [("hello", "hello"), ("", ""), (None, None)]
    assert got[0]["n"] == 12 + 5 + 16
    twice = spark.range(2).select(seal(F.lit("same"), key).alias("s")).distinct().count()
    assert twice == 2  # a fresh nonce per value


def test_wrong_key_and_tampering_are_seen(spark):
    right, wrong = (secret_column(spark, derive_key(p, SALT, 10)) for p in ("a", "b"))
    sealed = seal_rows(spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), "v", right)
    assert open_rows(sealed, "v", wrong).where("intact").count() == 0
    broken = sealed.withColumn("sealed", F.when(F.col("id") == 1, F.concat(F.expr("substring(sealed, 1, length(sealed) - 1)"), F.lit(b"\x00"))).otherwise(F.col("sealed")))
    got = {r["id"]: r["intact"] for r in open_rows(broken, "v", right).collect()}
    assert got[2] is True and got[1] is False
    with pytest.raises(Exception, match="(?i)decrypt|aes"):
        sealed.select(open_sealed(F.col("sealed"), wrong, strict=True)).collect()


def test_secrets_stay_out_of_plans(spark):
    secret = derive_key("pw", SALT, 10)
    df = spark.range(3).select(
        seal(F.col("id").cast("string"), secret_column(spark, secret)).alias("s"),
        keyed_id(F.col("id"), "c", secret_column(spark, "very-secret-salt")).alias("i"),
    )
    text = plan_of(df) + df._jdf.queryExecution().toString()
    assert "very-secret-salt" not in text and secret.hex().upper() not in text.upper()


def test_files_round_trip_with_a_salt_per_file(spark, folder):
    spark.range(100).coalesce(1).write.parquet(f"{folder}/t")
    plain = {p.name: p.read_bytes() for p in Path(folder, "t").glob("*.parquet")}
    one = seal_files(spark, f"{folder}/t", "pw")
    two = seal_files(spark, f"{folder}/t", "pw", os.urandom(16)).withColumn("file", F.concat(F.lit("two-"), "file"))
    opened = {r["file"]: r for r in open_files(one.unionByName(two), "pw").collect()}
    assert len(opened) == 2 * len(plain)
    for name, content in plain.items():
        for key in (name, f"two-{name}"):
            assert opened[key]["intact"] and bytes(opened[key]["content"]) == content
    sealed = one.first()
    assert sealed["sealed_bytes"] == sealed["plain_bytes"] + 16 + 12 + 16
    assert open_files(one, "other").where("intact").count() == 0
