"""Applying a batch to a target: full, append, upsert, with schema evolution.

These are pure plans: they return the new content of the target and write nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.functions.names import find, require
from pitsync.functions.ordering import By, OrderKey
from pitsync.operators.dedupe import latest_per_key
from pitsync.operators.project import LOAD_STAMP, align_to, merge_schema

NULL_KEYS = ("reject", "equal")
STRATEGIES = ("outer", "lookup")


def full_load(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Truncate and load: batch rows in the evolved target schema."""
    return align_to(batch, merge_schema(target.schema, batch.schema))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows plus batch rows; columns one side lacks are NULL there."""
    schema = merge_schema(target.schema, batch.schema)
    return align_to(target, schema).unionByName(align_to(batch, schema))


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job on a NULL merge key instead of silently losing or doubling rows."""
    ok: Column = F.lit(True)
    for key in keys:
        ok = ok & F.col(require(df, key)).isNotNull()
    message = F.lit(f"NULL in merge key ({', '.join(keys)})")
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderKey] = (),
    ties: Sequence[OrderKey] | None = None,
    null_keys: str = "reject",
    run_ts: Any = None,
    stamp_column: str = LOAD_STAMP,
    strategy: str = "outer",
    deduplicated: bool = False,
) -> DataFrame:
    """Update matching keys, insert the rest, keep target rows the batch does not touch.

    The batch is first reduced to one row per key by ``order``. A matched row takes every
    batch column, NULLs included; target-only columns keep their value on update and are
    NULL on insert. ``run_ts`` fills the load stamp of inserted rows; updates keep theirs.
    Batches of key columns only insert. The target is expected to be unique on the keys.

    ``outer``: one full outer join, one shuffle of both sides. ``lookup``: for a batch far
    smaller than the target. The target is left-joined and semi-joined, so when Catalyst
    sees the batch is below its broadcast threshold, the target is not shuffled at all.
    The batch is read three times there, so hand over a staged table, not a long plan.
    """
    if not keys:
        raise ValueError("upsert needs merge keys")
    if null_keys not in NULL_KEYS or strategy not in STRATEGIES:
        raise ValueError(f"null_keys in {NULL_KEYS}, strategy in {STRATEGIES}")
    schema = merge_schema(target.schema, batch.schema)
    batch_keys = [require(batch, k) for k in keys]
    if null_keys == "reject":
        batch = reject_null_keys(batch, batch_keys)
    if not deduplicated:
        batch = latest_per_key(batch, batch_keys, order, ties)

    names = [f.name for f in schema.fields]
    key_names = [require(target, k) for k in keys]
    in_batch = {n for n in names if find(batch, n)}
    in_target = {n for n in names if find(target, n)}
    t = align_to(target, schema).withColumn("__t", F.lit(True))
    b = align_to(batch, schema)
    b = b.select(*[F.col(f"`{n}`").alias(f"__b_{n}") for n in names if n in in_batch]).withColumn(
        "__b", F.lit(True)
    )

    def on(left: DataFrame, prefix: str = "") -> Column:
        cond = F.lit(True)
        for k in key_names:
            lhs, rhs = left[f"{prefix}{k}"], b[f"__b_{k}"]
            cond = cond & (lhs.eqNullSafe(rhs) if null_keys == "equal" else lhs == rhs)
        return cond

    new, old = F.col("__b").isNotNull(), F.col("__t").isNotNull()
    out = []
    for n in names:
        mine, theirs = F.col(f"`{n}`"), F.col(f"`__b_{n}`")
        if n in key_names:
            col = F.when(old, mine).otherwise(theirs)
        elif n.lower() == stamp_column.lower():
            fresh = theirs if n in in_batch else F.lit(None)
            if run_ts is not None:
                fresh = F.coalesce(fresh, F.lit(run_ts).cast(schema[n].dataType))
            col = F.when(old, mine).otherwise(fresh)
        elif n in in_batch:
            col = F.when(new, theirs).otherwise(mine) if n in in_target else theirs
        else:
            col = mine
        out.append(col.cast(schema[n].dataType).alias(n))

    if strategy == "outer":
        return t.join(b, on(t), "full_outer").select(*out)

    updated = t.join(b, on(t), "left").select(*out)
    known = t.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in key_names])
    known = known.join(b, on(known, "__k_"), "left_semi")
    missing = b.join(known, on(known, "__k_"), "left_anti")
    blanks = {n: F.lit(None).cast(schema[n].dataType) for n in names}
    inserted = missing.withColumns({**blanks, "__t": F.lit(None).cast("boolean")}).select(*out)
    return updated.unionByName(inserted)


BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row by its keys. Keys count as text without zeros at the end of a
    fraction, so a key keeps its bucket when its integer or decimal type widens."""

    def text(key: str) -> Column:
        plain = F.col(key).cast("string")
        return F.when(plain.rlike(r"^-?[0-9]+\.[0-9]+$"), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)

    return F.pmod(F.xxhash64(*[text(k) for k in keys]), F.lit(buckets)).cast("int")


def upsert_chunks(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], chunk: str, mark: str | None = None, **kw: Any
) -> DataFrame:
    """Apply many chunks at once: later chunks win, as if loaded one after the other."""
    order = [By(chunk), *([By(mark)] if mark else [])]
    reduced = latest_per_key(batch, keys, order, kw.pop("ties", None))
    return upsert(target, reduced.drop(chunk), keys, deduplicated=True, **kw)


def changed_partitions(
    target: DataFrame, batch: DataFrame, partition_by: Sequence[str], listed: int = 1000
) -> DataFrame:
    """Target rows in the partitions a batch touches.

    Up to ``listed`` distinct partition values are read from the batch (one small job, so
    hand over a staged batch) and become a partition filter: an upsert of a few months
    then opens only those months' files. Beyond that it is a semi join. Partition columns
    must not be NULL (see ``reject_null_keys``).
    """
    touched = batch.select(*[F.col(require(batch, c)).alias(f"__p_{c}") for c in partition_by]).distinct()
    values = touched.limit(listed + 1).collect()
    columns = [require(target, c) for c in partition_by]
    if len(values) > listed:
        cond = F.lit(True)
        for c, name in zip(partition_by, columns, strict=True):
            cond = cond & (target[name] == touched[f"__p_{c}"])
        return target.join(touched, cond, "left_semi")
    if len(columns) == 1:
        return target.where(F.col(columns[0]).isin([v[0] for v in values]))
    cond = F.lit(False)
    for value in values:
        one = F.lit(True)
        for name, part in zip(columns, value, strict=True):
            one = one & (F.col(name) == F.lit(part))
        cond = cond | one
    return target.where(cond)
