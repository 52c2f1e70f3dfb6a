"""Type names: source to target mapping, Spark types, and safe widenings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name -> target type name, where length and precision do not matter.
SIMPLE_TARGETS = {
    "INT": "INTEGER",
    "INTEGER": "INTEGER",
    "BIGINT": "BIGINT",
    "SMALLINT": "SMALLINT",
    "TINYINT": "SMALLINT",
    "BYTEINT": "SMALLINT",
    "FLOAT": "DOUBLE PRECISION",
    "FLOAT4": "REAL",
    "FLOAT8": "DOUBLE PRECISION",
    "DOUBLE": "DOUBLE PRECISION",
    "DOUBLE PRECISION": "DOUBLE PRECISION",
    "REAL": "REAL",
    "STRING": "TEXT",
    "TEXT": "TEXT",
    "BINARY": "BYTEA",
    "VARBINARY": "BYTEA",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP",
    "TIME": "TIME",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP_LTZ": "TIMESTAMP WITH TIME ZONE",
    "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ": "TIMESTAMP WITH TIME ZONE",
    "VARIANT": "JSONB",
    "OBJECT": "JSONB",
    "ARRAY": "JSONB",
}
# Limits of the mapping.
NUMBER_NAMES = ("NUMBER", "DECIMAL", "NUMERIC")
CHAR_NAMES = ("CHAR", "CHARACTER")
MAX_VARCHAR = 10_485_760
# Old type -> new types that hold every old value.
WIDENINGS = {
    "SMALLINT": ("INTEGER", "BIGINT", "NUMERIC"),
    "INTEGER": ("BIGINT", "NUMERIC"),
    "BIGINT": ("NUMERIC",),
    "REAL": ("DOUBLE PRECISION",),
}


def target_type(data_type: Column, max_length: Column, precision: Column, scale: Column) -> Column:
    """Target type of a catalog row. A number without a precision keeps full width."""
    name = F.upper(data_type)
    number = (
        F.when((F.coalesce(scale, F.lit(0)) > 0) & precision.isNotNull(), F.format_string("NUMERIC(%d,%d)", precision, scale))
        .when(F.coalesce(scale, F.lit(0)) > 0, F.lit("NUMERIC"))
        .when(precision <= 4, F.lit("SMALLINT"))
        .when(precision <= 9, F.lit("INTEGER"))
        .when(precision <= 18, F.lit("BIGINT"))
        .otherwise(F.lit("NUMERIC"))
    )
    varchar = F.when(
        (max_length > 0) & (max_length <= MAX_VARCHAR), F.format_string("VARCHAR(%d)", max_length)
    ).otherwise(F.lit("TEXT"))
    char = F.when(max_length > 0, F.format_string("CHAR(%d)", max_length)).otherwise(F.lit("CHAR(1)"))
    ladder = F.when(name.isin(*NUMBER_NAMES), number).when(name == "VARCHAR", varchar).when(name.isin(*CHAR_NAMES), char)
    for source, target in SIMPLE_TARGETS.items():
        ladder = ladder.when(name == source, F.lit(target))
    return ladder.otherwise(F.lit("TEXT"))


def spark_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """The Spark type that plays the target type's part."""
    name = name.upper()
    if name in NUMBER_NAMES:
        if scale:
            return T.DecimalType(precision or 38, scale)
        if precision is None or precision > 18:
            return T.DecimalType(38, 0)
        return T.ShortType() if precision <= 4 else T.IntegerType() if precision <= 9 else T.LongType()
    by_target = {
        "INTEGER": T.IntegerType(),
        "BIGINT": T.LongType(),
        "SMALLINT": T.ShortType(),
        "DOUBLE PRECISION": T.DoubleType(),
        "REAL": T.FloatType(),
        "BYTEA": T.BinaryType(),
        "BOOLEAN": T.BooleanType(),
        "DATE": T.DateType(),
        "TIMESTAMP": T.TimestampNTZType(),
        "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
        "JSONB": T.VariantType(),
    }
    return by_target.get(SIMPLE_TARGETS.get(name, "TEXT"), T.StringType())


def source_type(dtype: T.DataType) -> tuple[str, int | None, int | None]:
    """Catalog name, precision and scale of a Spark type."""
    if isinstance(dtype, T.DecimalType):
        return "NUMBER", dtype.precision, dtype.scale
    names = {
        T.ByteType: "SMALLINT",
        T.ShortType: "SMALLINT",
        T.IntegerType: "INTEGER",
        T.LongType: "BIGINT",
        T.FloatType: "REAL",
        T.DoubleType: "DOUBLE",
        T.StringType: "TEXT",
        T.BinaryType: "BINARY",
        T.BooleanType: "BOOLEAN",
        T.DateType: "DATE",
        T.TimestampNTZType: "TIMESTAMP_NTZ",
        T.TimestampType: "TIMESTAMP_LTZ",
        T.ArrayType: "ARRAY",
        T.StructType: "OBJECT",
        T.MapType: "OBJECT",
        T.VariantType: "VARIANT",
    }
    return names.get(type(dtype), "TEXT"), None, None


def is_widening(old: Column, new: Column) -> Column:
    """True where a change of target type from ``old`` to ``new`` loses nothing."""
    old, new = F.upper(old), F.upper(new)
    ok = F.lit(False)
    for narrow, wider in WIDENINGS.items():
        ok = ok | ((old == narrow) & new.isin(*wider))

    def length(c: Column) -> Column:
        return F.regexp_extract(c, r"^VARCHAR\((\d+)\)$", 1).try_cast("int")

    longer = old.startswith("VARCHAR") & new.startswith("VARCHAR") & (length(new) >= length(old))
    to_text = old.startswith("VARCHAR") & (new == "TEXT")
    return F.coalesce(ok | longer | to_text, F.lit(False))


_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The wider of two Spark types if one safely holds the other, else None."""
    if a == b:
        return a
    ta, tb = type(a), type(b)
    if ta in _RANK and tb in _RANK:
        return a if _RANK.index(ta) >= _RANK.index(tb) else b
    if {ta, tb} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DecimalType) and type(y) in _RANK:
            # what Parquet readers ask of a decimal that stands for stored 32- and 64-bit integers
            digits = 20 if type(y) is T.LongType else 10
            return _decimal(max(x.precision, digits + x.scale), x.scale)
    if ta is T.DecimalType and tb is T.DecimalType:
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return _decimal(whole + scale, scale)
    return None


def _decimal(precision: int, scale: int) -> T.DecimalType | None:
    """None where the digits of both types do not fit into one."""
    return T.DecimalType(precision, scale) if precision <= 38 else None
