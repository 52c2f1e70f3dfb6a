"""Exact dedup by a tree-merge of digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.llm.staging import stage, unused


def _digit(number: Column, place: int, base: int) -> Column:
    return F.floor(number / F.lit(base**place)) % base


def tree_merge(runs: DataFrame, rounds: int = 2, fan_in: int = 8) -> DataFrame:
    """Merge runs of (run, digest, n_bytes, best, n) into one entry per digest.

    Runs are numbered with ``rounds`` digits to the base ``fan_in``. In round r the
    ``fan_in`` runs that differ in digit r alone exchange entries: each entry goes to
    the run whose digit r its digest asks for, where equal entries are merged. So each
    of the binomial rounds moves an entry once, every run keeps a slice of the digests,
    and after the last round all entries of a digest have met in one run. The merge
    combines before it shuffles, so a digest of a third of all rows arrives as one entry
    per task.
    """
    slot = F.pmod(F.xxhash64("digest"), F.lit(fan_in**rounds))
    for place in range(rounds):
        moved = (
            F.col("run")
            - _digit(F.col("run"), place, fan_in) * fan_in**place
            + _digit(slot, place, fan_in) * fan_in**place
        )
        runs = (
            runs.withColumn("run", moved.cast("int"))
            .groupBy("run", "digest", "n_bytes")
            .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        )
    return runs.drop("run")


def exact_dedup(docs: DataFrame, keep: str = "largest", rounds: int = 2, fan_in: int = 8) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when SHA-256 and length in bytes agree; nothing is normalised. Of
    equal texts the row with the largest (or ``smallest``) doc_id stays.

    A null text counts as empty, so all empty texts are one group. A null doc_id loses
    against any other. Rows repeated with one doc_id count each, and exactly one of them
    is kept. An empty table gives an empty result; other columns are not looked at.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.monotonically_increasing_id().alias("row_no"),
        F.pmod(F.spark_partition_id(), F.lit(fan_in**rounds)).alias("run"),
    )
    rows = stage(rows, "digests")
    rank = F.col("doc_id") if keep == "largest" else -F.col("doc_id")
    runs = rows.select("run", "digest", "n_bytes", F.struct(rank.alias("rank"), "row_no").alias("best"), F.lit(1).cast("long").alias("n"))
    best = tree_merge(runs, rounds, fan_in).select(
        F.col("digest").alias("d"), F.col("n_bytes").alias("b"), "best", F.col("n").alias("group_size")
    )
    keep_id = F.col("best.rank") if keep == "largest" else -F.col("best.rank")
    return rows.join(best, (F.col("digest") == F.col("d")) & (F.col("n_bytes") == F.col("b"))).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows repeated with one doc_id and text, one stays.
    """
    from pyspark.sql import Window

    kept_id, kept_sha = unused("kept_id", docs), unused("kept_sha", docs)
    kept = exact_dedup(docs, keep).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    stay = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(kept_id)) & (sha == F.col(kept_sha)), "left_semi")
    one = Window.partitionBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).orderBy(F.lit(1))
    columns, number = [F.col(f"`{c}`") for c in stay.columns], unused("copy_no", docs)
    return stay.select(*columns, F.row_number().over(one).alias(number)).where(F.col(number) == 1).select(*columns)
