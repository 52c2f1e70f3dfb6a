"""Projections: derived keys, JSON unpacking, normalisation, alignment, load stamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.names import find
from pitsync.functions.types import wider_type

LOAD_STAMP = "data_inserted_at"


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns from SQL expressions: ``{"month_end": "last_day(o_orderdate)"}``."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def unpack_json(
    df: DataFrame,
    column: str,
    fields: Mapping[str, tuple[str, str]] | Sequence[tuple[str, str, str]],
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Typed columns from a JSON string or VARIANT column.

    ``fields`` maps a path (``$.k`` or just ``k``; case counts) to ``(name, type)``, or
    lists ``(path, name, type)`` if a path is wanted twice. A missing path is NULL. A value that does not cast is NULL too, or an error if strict.
    """
    if isinstance(df.schema[column].dataType, T.VariantType):
        parsed = F.col(column)
    else:
        parsed = F.parse_json(column) if strict else F.try_parse_json(column)
    get = F.variant_get if strict else F.try_variant_get
    out = df.withColumn("__v", parsed)
    columns = []
    triples = [(p, *rest) for p, rest in fields.items()] if isinstance(fields, Mapping) else fields
    for path, name, dtype in triples:
        json_path = path if path.startswith("$") else f"$.{path}"
        columns.append(get(F.col("__v"), json_path, dtype).alias(name))
    return out.select(*columns, *keep)


def normalise(df: DataFrame) -> DataFrame:
    """Lower-case names; NaN becomes NULL in floating columns."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(f.name.lower()))
    return df.select(*out)


def stamp(df: DataFrame, run_ts: Any, column: str = LOAD_STAMP) -> DataFrame:
    """Set the load time on rows that have none."""
    value = F.lit(run_ts).cast("timestamp_ntz")
    existing = find(df, column)
    if existing:
        value = F.coalesce(F.col(existing), value)
    return df.withColumn(existing or column, value)


UNSAFE = ("raise", "cast")


def merge_schema(target: T.StructType, batch: T.StructType, unsafe: str = "raise") -> T.StructType:
    """Target columns in order, then new batch columns; types widen where that is safe, and
    a text column takes any single value as text.

    Other types that do not fit each other raise, as a cast would change or lose values. With
    ``unsafe="cast"`` the target's type stays and batch values are cast to it.
    """
    if unsafe not in UNSAFE:
        raise ValueError(f"unsafe must be one of {UNSAFE}")
    incoming = {f.name.lower(): f for f in batch.fields}
    fields = []
    for f in target.fields:
        other = incoming.pop(f.name.lower(), None)
        dtype = f.dataType if other is None else wider_type(f.dataType, other.dataType)
        if dtype is None and isinstance(f.dataType, T.StringType):
            dtype = f.dataType if isinstance(other.dataType, T.AtomicType) and not isinstance(other.dataType, T.BinaryType) else None
        if dtype is None:
            if unsafe == "raise":
                kinds = f.dataType.simpleString(), other.dataType.simpleString()
                raise ValueError(f"column {f.name} is {kinds[0]} in the target and {kinds[1]} in the batch")
            dtype = f.dataType
        fields.append(T.StructField(f.name, dtype, True, f.metadata))
    fields += [T.StructField(f.name, f.dataType, True, f.metadata) for f in incoming.values()]
    return T.StructType(fields)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: cast by name, missing ones NULL, extra ones gone."""
    out = []
    for f in schema.fields:
        name = find(df, f.name)
        col = F.lit(None) if name is None else F.col(f"`{name}`")
        out.append(col.cast(f.dataType).alias(f.name))
    return df.select(*out)


def add_missing_keys(df: DataFrame, keys: Mapping[str, T.DataType | str] | Sequence[str]) -> DataFrame:
    """Merge keys the frame lacks, added as NULLs of the given type (text by default)."""
    types = dict(keys) if isinstance(keys, Mapping) else dict.fromkeys(keys, "string")
    new = {k: F.lit(None).cast(t) for k, t in types.items() if find(df, k) is None}
    return df.withColumns(new) if new else df
