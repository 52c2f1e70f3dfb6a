"""A space-filling key: rows that are close in several columns come close in one order."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bits of a key, which is a non-negative long.
KEY_BITS = 62
#: Bytes of a text that take part, as a double keeps 53 bits exactly.
TEXT_BYTES = 6


def as_number(column: str, dtype: T.DataType) -> Column:
    """A double that grows with the column; texts by their first bytes."""
    col = F.col(f"`{column}`")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        start = F.substring(col.cast("binary"), 1, TEXT_BYTES)
        return F.conv(F.rpad(F.hex(start), 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    raise ValueError(f"column {column} is {dtype.simpleString()}, which has no place on a curve")


def interleave(ranks: Sequence[Column], bits: int) -> Column:
    """One long with the bits of all ranks in turn, highest first (Morton order)."""
    n = len(ranks)
    spread = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")), b * n + n - 1 - k) for b in range(bits) for k, r in enumerate(ranks)]
    return reduce(lambda a, b: a.bitwiseOR(b), spread)


def with_curve_key(df: DataFrame, columns: Sequence[str], name: str, bits: int = 10) -> DataFrame:
    """``df`` with the long ``name``, the place of each row on a Morton curve over ``columns``.

    A column enters by its rank among ``2 ** bits`` slices of about equal row counts, so
    skewed values use the curve as evenly as uniform ones; a column of few values has its
    slices spread over all bits. One aggregation finds the
    approximate quantiles that cut the slices; the driver gets at most ``2 ** bits`` numbers a
    column. NULL and NaN come last. Repeated rows have equal places, and an empty frame
    stays empty.
    """
    if not columns:
        raise ValueError("a curve needs at least one column")
    bits = min(bits, KEY_BITS // len(columns))
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    numbers = [as_number(c, types[c.lower()]) for c in columns]
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(x, cuts, 10 * 2**bits).alias(f"c{k}") for k, x in enumerate(numbers)]).first()
    splits = []
    for values in found:
        inner = sorted({v for v in values or [] if math.isfinite(v)})
        splits.append([-math.inf, *(inner or [0.0]), math.inf])
    inside, outside = [f"{name}_in_{k}" for k in range(len(columns))], [f"{name}_out_{k}" for k in range(len(columns))]
    nan = F.lit(math.nan)
    wide = df.select("*", *[F.coalesce(x, nan).alias(c) for c, x in zip(inside, numbers, strict=True)])
    ranked = Bucketizer(splitsArray=splits, inputCols=inside, outputCols=outside, handleInvalid="keep").transform(wide)
    # Bucketizer numbers the slices from 0; NULL and NaN are in the one after the last
    ranks = [F.floor(F.col(c) * 2**bits / len(own)) for c, own in zip(outside, splits, strict=True)]
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], interleave(ranks, bits).alias(name))
