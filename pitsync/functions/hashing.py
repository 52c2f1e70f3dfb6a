"""Content hashes and keyed identifiers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(name: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(col)
    return col.cast("string")


def _chosen(schema: T.StructType, columns: Sequence[str] | None) -> list[T.StructField]:
    if columns is None:
        return list(schema.fields)
    by_name = {f.name.lower(): f for f in schema.fields}
    return [by_name[c.lower()] for c in columns]


#: types whose text never holds the separator
_PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_hash(schema: T.StructType, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 of a row. Values are joined by ``|``; texts are written as ``length:text``
    and NULL as ``-``, so neither separators inside texts nor NULLs can make two rows
    look alike."""
    parts = []
    for f in _chosen(schema, columns):
        text = _text(f.name, f.dataType)
        if not isinstance(f.dataType, _PLAIN):
            text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(text, F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def hash_inputs(fields: Sequence[T.StructField]) -> list[Column]:
    """What to hand to ``xxhash64`` so that it tells all values apart.

    The function skips NULLs, wherever they are, so the flags of the columns come first
    and nested values enter as JSON that spells its NULLs out.
    """
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    names = [F.col(f"`{f.name}`") for f in fields]
    values = [F.to_json(c, {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else c for c, f in zip(names, fields, strict=True)]
    return [*[c.isNull() for c in names], *values]


def row_words(schema: T.StructType, columns: Sequence[str] | None = None) -> list[Column]:
    """Two independent 64-bit hashes of a row, much cheaper than SHA-256: no plain value
    becomes text."""
    inputs = hash_inputs(_chosen(schema, columns))
    return [F.xxhash64(F.lit(seed), *inputs) for seed in (1, 2)]


_PIECE_BITS = 16


def word_pieces(words: Sequence[Column]) -> list[Column]:
    """Cut 64-bit words into 16-bit pieces: a BIGINT sum of them holds 1.4 * 10**14 rows."""
    mask = F.lit((1 << _PIECE_BITS) - 1)
    return [F.shiftright(w, at * _PIECE_BITS).bitwiseAND(mask) for w in words for at in range(64 // _PIECE_BITS)]


def multiset_digest(words: Sequence[Column]) -> Column:
    """Aggregate: one hash for an unordered group of rows, given their ``row_words``.

    The eight sums and the row count are commutative, so Spark combines them before the
    shuffle and a hot group never sits in one task; sorting and joining the hashes of a
    group would need exactly that.
    """
    sums = [F.sum(piece).cast("string") for piece in word_pieces(words)]
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256)


def no_rows_digest() -> Column:
    """What ``multiset_digest`` gives for no rows, which no group stands for."""
    return F.sha2(F.lit("0"), 256)


def keyed_id(key: Column, context: str = "", salt: Column | str = "", length: int = 16) -> Column:
    """Deterministic identifier: leading hex digits of ``sha256(salt:key:context)``.

    Pass the salt as a scalar-subquery column (see ``secrets.secret_column``) to keep
    it out of plan text.
    """
    salt_col = F.lit(salt) if isinstance(salt, str) else salt
    text = F.concat_ws(":", salt_col, key.cast("string"), F.lit(context))
    return F.when(key.isNotNull(), F.substring(F.sha2(text, 256), 1, length))


def table_folder_id(table: Column, salt: Column | str = "", length: int = 16) -> Column:
    return keyed_id(table, "folder", salt, length)


def chunk_file_id(table: Column, chunk: Column, salt: Column | str = "", length: int = 16) -> Column:
    key = F.concat(table, F.lit(":chunk:"), chunk.cast("string"))
    return keyed_id(key, "data", salt, length)


def manifest_id(table: Column, salt: Column | str = "", length: int = 16) -> Column:
    return keyed_id(table, "manifest", salt, length)


def metadata_file_id(
    table: Column, kind: str, date: Column | None = None, salt: Column | str = "", length: int = 16
) -> Column:
    """``kind`` is metadata, ddl or changes; with a date the id names an archived file."""
    if date is None:
        return keyed_id(table, kind, salt, length)
    key = F.concat_ws(":", table, F.lit(kind), date.cast("string"))
    return keyed_id(key, "", salt, length)
