"""Type and layout advice from one profiling pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thresholds and limits of the advice rules.
CATEGORY_RATIO = 0.5
FLOAT32_LIMIT = 3.4e38
# Integer types by capacity, narrowest first.
INT_LADDER = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
)
# Assumed bytes per value for the reduction estimate.
WIDTHS = {
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "bigint": 8,
    "float": 4,
    "double": 8,
    "boolean": 1,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
    "string": 16,
    "category": 4,
}

_INTS = (T.ShortType, T.IntegerType, T.LongType)
_ADVICE = "column string, from_type string, to_type string, rule string, metric double"


def _row(name: str, source: str, target: Column, rule: str, metric: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(source).alias("from_type"),
        target.alias("to_type"),
        F.lit(rule).alias("rule"),
        metric.cast("double").alias("metric"),
    )


def advise_types(
    df: DataFrame,
    aggressive: bool = False,
    threshold: float = CATEGORY_RATIO,
    exact: bool = True,
    rsd: float = 0.02,
) -> DataFrame:
    """Columns that fit a smaller type: ``column, from_type, to_type, rule, metric``.

    Integers take the narrowest type that holds their range; with ``aggressive``, doubles
    below float32's limit become floats; strings whose distinct share of all rows is
    below ``threshold`` become categories. ``metric`` is the largest magnitude, or the
    share. Ranges need one aggregation without a shuffle of rows. Distinct counts are
    exact by default, on 128-bit hashes; ``exact=False`` estimates them, and
    ``operators.sketches`` keeps sketches by file and recounts only close calls.
    """
    ranges: list[Column] = []
    rows: list[Column] = []
    for f in df.schema.fields:
        col, n = F.col(f"`{f.name}`"), f.name
        if isinstance(f.dataType, _INTS):
            ranges += [F.min(col).alias(f"__lo_{n}"), F.max(col).alias(f"__hi_{n}")]
            lo, hi = F.col(f"`__lo_{n}`"), F.col(f"`__hi_{n}`")
            source = f.dataType.simpleString()
            ladder = F.lit(None).cast("string")
            for name, least, most in reversed(INT_LADDER):
                if WIDTHS[name] < WIDTHS[source]:
                    ladder = F.when((lo >= least) & (hi <= most), F.lit(name)).otherwise(ladder)
            magnitude = F.greatest(F.abs(lo.cast("double")), F.abs(hi.cast("double")))
            rows.append(_row(n, source, ladder, "int_downcast", magnitude))
        elif isinstance(f.dataType, T.DoubleType) and aggressive:
            ranges.append(F.max(F.abs(F.when(~F.isnan(col), col))).alias(f"__hi_{n}"))
            hi = F.col(f"`__hi_{n}`")
            target = F.when(hi < FLOAT32_LIMIT, F.lit("float"))
            rows.append(_row(n, "double", target, "float_downcast", hi))

    advice = None
    if rows:
        advice = df.agg(*ranges).select(F.explode(F.array(*rows)).alias("a")).select("a.*")
    shares = distinct_shares(df, exact, rsd)
    if shares is not None:
        low = shares.where(F.col("share") < threshold).select(
            "column",
            F.lit("string").alias("from_type"),
            F.lit("category").alias("to_type"),
            F.lit("category").alias("rule"),
            F.col("share").alias("metric"),
        )
        advice = low if advice is None else advice.unionByName(low)
    if advice is None:
        return df.sparkSession.createDataFrame([], _ADVICE)
    return advice.where(F.col("to_type").isNotNull())


def distinct_shares(df: DataFrame, exact: bool = True, rsd: float = 0.02) -> DataFrame | None:
    """Distinct non-NULL values as a share of all rows, per string column; NULL if empty."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return None
    if exact:
        counted = distinct_counts(df, names)
        total = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
        listed = df.sparkSession.createDataFrame([(n,) for n in names], "column string")
        share = F.when(total > 0, F.coalesce("distinct_count", F.lit(0)) / total)
        return listed.join(counted, "column", "left").select("column", share.alias("share"))
    counts = [F.approx_count_distinct(f"`{n}`", rsd).alias(f"__d_{n}") for n in names]
    profile = df.select(*[f"`{n}`" for n in names]).agg(F.count(F.lit(1)).alias("__rows"), *counts)
    share = [
        F.struct(
            F.lit(n).alias("column"),
            F.when(F.col("__rows") > 0, F.col(f"`__d_{n}`") / F.col("__rows")).alias("share"),
        )
        for n in names
    ]
    return profile.select(F.explode(F.array(*share)).alias("s")).select("s.*")


def distinct_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """(column, distinct_count) of non-NULL values, by two 64-bit hashes of each.

    Hashes combine before the shuffle, and 20 bytes travel for a value, however long it is.
    Two values agree in both hashes by a chance of 2^-128 a pair.
    """
    marks = [F.when(F.col(f"`{n}`").isNotNull(), F.struct(F.lit(k).alias("k"), *[F.xxhash64(F.lit(s), F.col(f"`{n}`")).alias(f"h{s}") for s in (1, 2)])) for k, n in enumerate(names)]
    values = df.select(F.explode(F.array(*marks)).alias("v")).where("v IS NOT NULL").select("v.*")
    counted = values.groupBy("k", "h1", "h2").agg(F.lit(1).alias("one")).groupBy("k").agg(F.count("one").alias("distinct_count"))
    return counted.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1).alias("column"), "distinct_count")


def dictionary_columns(df: DataFrame, threshold: float = CATEGORY_RATIO, exact: bool = True) -> DataFrame:
    """Columns worth a Parquet dictionary: low-share strings; all byte, short and
    boolean columns by their type alone."""
    spark = df.sparkSession
    small = [
        (f.name, f.dataType.simpleString())
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.BooleanType))
    ]
    by_type = spark.createDataFrame(small, "column string, reason string")
    shares = distinct_shares(df, exact)
    if shares is None:
        return by_type
    low = shares.where(F.col("share") < threshold)
    return low.select("column", F.lit("low_cardinality").alias("reason")).unionByName(by_type)


def apply_types(df: DataFrame, advice: list[tuple[str, str]]) -> DataFrame:
    """Cast columns as advised, ``[(column, to_type)]``; categories stay strings, because
    a Parquet dictionary gives them their compact form."""
    casts = {c: F.col(f"`{c}`").cast(t) for c, t in advice if t != "category"}
    return df.withColumns(casts) if casts else df


def reduction(df: DataFrame, advice: DataFrame) -> DataFrame:
    """Estimated bytes per row before and after the advice, and the saving in percent.

    An estimate from a fixed width per type, not a measurement: see ``compare_layouts``
    for measured file sizes.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    spark = df.sparkSession
    schema = spark.createDataFrame([(n, t, WIDTHS.get(t, 16)) for n, t in fields], "column string, type string, width int")
    widths = spark.createDataFrame(list(WIDTHS.items()), "to_type string, new_width int")
    sized = schema.join(advice.select("column", "to_type"), "column", "left").join(widths, "to_type", "left")
    before = F.sum("width").cast("long")
    after = F.sum(F.coalesce("new_width", "width")).cast("long")
    return sized.agg(
        before.alias("bytes_before"),
        after.alias("bytes_after"),
        F.round((before - after) * 100.0 / before, 2).alias("reduction_pct"),
        F.count("to_type").alias("columns_changed"),
    )
