"""Column catalogs, schema diffs, evolution decisions and the change log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.types import is_widening, source_type, target_type
from pitsync.operators.project import LOAD_STAMP

CATALOG = (
    "table_name string, column_name string, data_type string, is_nullable boolean, "
    "default_value string, max_length int, precision int, scale int, position int"
)


def catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column, from the schema of a table or of any query output."""
    rows = []
    for table, df in tables.items():
        for position, f in enumerate(df.schema.fields, start=1):
            name, precision, scale = source_type(f.dataType)
            rows.append(
                (table, f.name, name, f.nullable, None, f.metadata.get("max_length"), precision, scale, position)
            )
    return with_target_types(spark.createDataFrame(rows, CATALOG))


def with_target_types(columns: DataFrame) -> DataFrame:
    mapped = target_type(F.col("data_type"), F.col("max_length"), F.col("precision"), F.col("scale"))
    return columns.withColumn("target_type", mapped)


def observe_catalog(df: DataFrame, table: str) -> DataFrame:
    """Catalog rows as the data shows them, in one pass: text lengths, integer digits,
    and whether NULLs occur. A column without values keeps its declared type."""
    aggregates: list[Column] = []
    rows: list[Column] = []
    for position, f in enumerate(df.schema.fields, start=1):
        col = F.col(f"`{f.name}`")
        name, precision, scale = source_type(f.dataType)
        length: Column = F.lit(None).cast("int")
        digits: Column = F.lit(precision).cast("int")
        kind: Column = F.lit(name)
        if isinstance(f.dataType, T.StringType):
            aggregates.append(F.max(F.length(col)).alias(f"__m{position}"))
            length = F.col(f"__m{position}")
            kind = F.when(length.isNotNull(), F.lit("VARCHAR")).otherwise(F.lit(name))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            aggregates += [F.min(col).alias(f"__lo{position}"), F.max(col).alias(f"__hi{position}")]
            low, high = (F.abs(F.col(f"__{end}{position}").cast("decimal(20,0)")) for end in ("lo", "hi"))
            digits = F.length(F.greatest(low, high).cast("string"))
            kind = F.when(digits.isNotNull(), F.lit("NUMBER")).otherwise(F.lit(name))
            scale = 0
        aggregates.append((F.count_if(col.isNull()) > 0).alias(f"__n{position}"))
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                kind.alias("data_type"),
                F.col(f"__n{position}").alias("is_nullable"),
                F.lit(None).cast("string").alias("default_value"),
                length.alias("max_length"),
                digits.alias("precision"),
                F.lit(scale).cast("int").alias("scale"),
                F.lit(position).alias("position"),
            )
        )
    seen = df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("c")).select("c.*")
    return with_target_types(seen)


def table_statistics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of each table; column pruning reduces each scan to footers."""
    out = None
    for name, df in tables.items():
        counted = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = counted if out is None else out.unionByName(counted)
    if out is None:
        raise ValueError("no tables given")
    return out


def table_metadata(columns: DataFrame, statistics: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Catalog rows with their table's row count and their place in its primary key."""
    keys = primary_keys.select("table_name", "column_name", F.col("ordinal_position").alias("key_position"))
    joined = columns.join(statistics, "table_name", "left").join(keys, ["table_name", "column_name"], "left")
    return joined.select(
        "table_name", "column_name", "data_type", "target_type", "position", "key_position", "row_count"
    )


def primary_key_columns(constraints: DataFrame, key_usage: DataFrame) -> DataFrame:
    """Primary-key columns in key order, from constraint and key-usage rows that share
    ``constraint_name`` and ``table_name``."""
    joined = constraints.join(key_usage, ["constraint_name", "table_name"])
    primary = joined.where(F.col("constraint_type") == "PRIMARY KEY")
    return primary.select("table_name", "column_name", "ordinal_position").orderBy("table_name", "ordinal_position")


def constraint_columns(constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """Column names of each constraint, in key order.

    ``constraints`` has ``table_name, constraint_name, key`` with an array of column
    positions; ``columns`` is a catalog. A group is one constraint, so its size is
    bounded by the table's column count.
    """
    parts = constraints.select("table_name", "constraint_name", F.posexplode("key").alias("__n", "__position"))
    named = parts.join(
        columns.select(
            F.col("table_name").alias("__table"), F.col("position").alias("__at"), "column_name"
        ),
        (F.col("table_name") == F.col("__table")) & (F.col("__position") == F.col("__at")),
    )
    grouped = named.groupBy("table_name", "constraint_name").agg(
        F.array_sort(F.collect_list(F.struct("__n", "column_name"))).alias("__cols")
    )
    return grouped.select("table_name", "constraint_name", F.expr("transform(__cols, c -> c.column_name)").alias("columns"))


def same_key(columns: Column, keys: Sequence[str]) -> Column:
    """Whether a constraint's columns are the wanted keys, in any order or case."""
    wanted = F.array_sort(F.array(*[F.lit(k.lower()) for k in keys]))
    return F.array_sort(F.array_distinct(F.transform(columns, F.lower))) == wanted


def _change(kind: str, old: Column, new: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("change"), old.cast("string").alias("old_value"), new.cast("string").alias("new_value")
    )


def schema_diff(old: DataFrame, new: DataFrame, type_column: str = "target_type") -> DataFrame:
    """Changes between two column catalogs: ``table_name, column_name, change, old_value,
    new_value``, names matched without regard to case.

    Changes: column_added, column_removed, column_type_changed, column_nullable_changed,
    column_position_changed.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            F.col("table_name").alias(f"{tag}_table"),
            F.col("column_name").alias(f"{tag}_name"),
            F.col(type_column).alias(f"{tag}_type"),
            F.col("is_nullable").alias(f"{tag}_nullable"),
            F.col("position").alias(f"{tag}_position"),
        )

    o, n = side(old, "old"), side(new, "new")
    joined = o.join(
        n,
        (F.upper("old_table") == F.upper("new_table")) & (F.upper("old_name") == F.upper("new_name")),
        "full_outer",
    )
    none = F.lit(None)
    added, removed = F.col("old_name").isNull(), F.col("new_name").isNull()
    both = ~added & ~removed
    found = F.array(
        F.when(added, _change("column_added", none, F.col("new_type"))),
        F.when(removed, _change("column_removed", F.col("old_type"), none)),
        *[
            F.when(
                both & ~F.col(f"old_{what}").eqNullSafe(F.col(f"new_{what}")),
                _change(f"column_{what}_changed", F.col(f"old_{what}"), F.col(f"new_{what}")),
            )
            for what in ("type", "nullable", "position")
        ],
    )
    return joined.select(
        F.coalesce("new_table", "old_table").alias("table_name"),
        F.coalesce("new_name", "old_name").alias("column_name"),
        F.explode(F.array_compact(found)).alias("c"),
    ).select("table_name", "column_name", "c.*")


def property_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Table-level changes between ``table_name, primary_key, foreign_keys, comment,
    clustering_key`` rows; primary keys compare as sets, the rest as they are."""
    names = {
        "primary_key": "primary_key_changed",
        "foreign_keys": "foreign_keys_changed",
        "comment": "comment_changed",
        "clustering_key": "clustering_key_changed",
    }
    o = old.select(F.col("table_name").alias("__t"), *[F.col(c).alias(f"old_{c}") for c in names])
    n = new.select("table_name", *[F.col(c).alias(f"new_{c}") for c in names])
    joined = n.join(o, F.upper("table_name") == F.upper("__t"))
    found = []
    for c, kind in names.items():
        a, b = F.col(f"old_{c}"), F.col(f"new_{c}")
        if c == "primary_key":
            a, b = F.array_sort(F.array_distinct(a)), F.array_sort(F.array_distinct(b))
        found.append(F.when(~a.eqNullSafe(b), _change(kind, F.to_json(F.struct(a)), F.to_json(F.struct(b)))))
    return joined.select(
        "table_name", F.lit(None).cast("string").alias("column_name"), F.explode(F.array_compact(F.array(*found))).alias("c")
    ).select("table_name", "column_name", "c.*")


def classify(changes: DataFrame) -> DataFrame:
    """Adds ``safe``: additions, widenings and NOT NULL to NULL; all else is breaking."""
    kind = F.col("change")
    safe = (
        F.when(kind == "column_added", F.lit(True))
        .when(kind == "column_type_changed", is_widening(F.col("old_value"), F.col("new_value")))
        .when(kind == "column_nullable_changed", (F.col("new_value") == "true") & (F.col("old_value") == "false"))
        .otherwise(F.lit(False))
    )
    return changes.withColumn("safe", F.coalesce(safe, F.lit(False)))


# Changes that can be applied to a target, and what is done for them.
ACTIONS = {
    "column_added": "add_column",
    "column_type_changed": "alter_type",
    "column_nullable_changed": "drop_not_null",
}


def evolve_actions(classified: DataFrame, force: bool = False) -> DataFrame:
    """Action per change. Breaking ones are ``blocked`` unless forced; forced removals and
    reorderings are ``ignored``, since a target never loses a column."""
    action = F.lit("ignored")
    for change, name in ACTIONS.items():
        doable = F.col("change") == change
        if change == "column_nullable_changed":
            doable = doable & (F.col("new_value") == "true")
        action = F.when(doable, F.lit(name)).otherwise(action)
    if not force:
        action = F.when(~F.col("safe"), F.lit("blocked")).otherwise(action)
    return classified.withColumn("action", action)


def evolve_decision(classified: DataFrame, force: bool = False) -> DataFrame:
    """Per table: ``status`` blocked, no_changes or success, with counts."""
    acts = evolve_actions(classified, force)
    grouped = acts.groupBy("table_name").agg(
        F.count_if("safe").alias("safe_count"),
        F.count_if(~F.col("safe")).alias("breaking_count"),
        F.count_if(F.col("action").isin(*ACTIONS.values())).alias("action_count"),
    )
    status = F.when(F.col("action_count") > 0, F.lit("success")).otherwise(F.lit("no_changes"))
    if not force:
        status = F.when(F.col("breaking_count") > 0, F.lit("blocked")).otherwise(status)
    return grouped.withColumn("status", status)


def migration_rows(actions: DataFrame, run_ts: Any) -> DataFrame:
    """Migration log rows: per table the applied actions, a summary and the time. A group
    is one table's columns."""
    applied = actions.where(F.col("action").isin(*ACTIONS.values()))
    step = F.concat_ws(" ", "action", "column_name", F.when(F.col("change") != "column_nullable_changed", F.col("new_value")))
    grouped = applied.groupBy("table_name").agg(
        F.array_join(F.array_sort(F.collect_list(step)), "; ").alias("steps"), F.count(F.lit(1)).alias("n")
    )
    return grouped.select(
        "table_name",
        F.lit("alter_table").alias("action"),
        "steps",
        F.format_string("Applied %d change(s)", "n").alias("summary"),
        F.lit(run_ts).cast("timestamp_ntz").alias("applied_at"),
    )


# Wording and order of the change summary.
SUMMARY_PARTS = (
    ("column_added", "column", " added"),
    ("column_removed", "column", " removed"),
    ("column_type_changed", "type", " changed"),
    ("column_nullable_changed", "nullable constraint", " changed"),
)
SUMMARY_FLAGS = (("primary_key_changed", "primary key changed"), ("foreign_keys_changed", "foreign keys changed"))


def summarise_changes(changes: DataFrame) -> DataFrame:
    """One sentence per table, e.g. ``2 columns added, 1 type changed``. Kinds without a
    wording of their own count once each as other changes."""
    named = [k for k, _, _ in SUMMARY_PARTS] + [k for k, _ in SUMMARY_FLAGS]
    per_kind = changes.groupBy("table_name", "change").agg(F.count(F.lit(1)).alias("n"))
    counts = per_kind.groupBy("table_name").agg(
        *[F.sum(F.when(F.col("change") == k, F.col("n"))).alias(k) for k in named],
        F.count_if(~F.col("change").isin(*named)).alias("other"),
    )
    parts = []
    for kind, noun, verb in SUMMARY_PARTS:
        n = F.col(kind)
        plural = F.when(n > 1, F.lit("s")).otherwise(F.lit(""))
        parts.append(F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {noun}"), plural, F.lit(verb))))
    parts += [F.when(F.col(kind) > 0, F.lit(text)) for kind, text in SUMMARY_FLAGS]
    other = F.col("other")
    plural = F.when(other > 1, F.lit("s")).otherwise(F.lit(""))
    parts.append(F.when(other > 0, F.concat(other.cast("string"), F.lit(" other change"), plural)))
    return counts.select("table_name", F.concat_ws(", ", *parts).alias("summary"))


def structure_differences(source: DataFrame, target: DataFrame, stamp_column: str = LOAD_STAMP) -> DataFrame:
    """Columns only one of two catalogs has, apart from the target's load stamp."""
    def names(df: DataFrame) -> DataFrame:
        return df.select(F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name"))

    s = names(source)
    t = names(target).where(F.col("column_name") != stamp_column.lower())
    keys = ["table_name", "column_name"]
    missing = s.join(t, keys, "left_anti").withColumn("difference", F.lit("missing_in_target"))
    extra = t.join(s, keys, "left_anti").withColumn("difference", F.lit("only_in_target"))
    return missing.unionByName(extra)


def change_log_rows(changes: DataFrame, run_ts: Any) -> DataFrame:
    """Log rows ``table_name, logged_at, kind, change, column_name, details``."""
    details = F.to_json(F.struct("old_value", "new_value"))
    return changes.select(
        "table_name",
        F.lit(run_ts).cast("timestamp_ntz").alias("logged_at"),
        F.lit("schema_change").alias("kind"),
        "change",
        "column_name",
        details.alias("details"),
    )


def first_extraction_rows(tables: DataFrame, logged: DataFrame, run_ts: Any) -> DataFrame:
    """Log rows for tables that appear for the first time."""
    new = tables.select("table_name").distinct().join(logged.select("table_name").distinct(), "table_name", "left_anti")
    return new.select(
        "table_name",
        F.lit(run_ts).cast("timestamp_ntz").alias("logged_at"),
        F.lit("initial_extraction").alias("kind"),
        F.lit(None).cast("string").alias("change"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("details"),
    )


def history_between(log: DataFrame, time_column: str, start: Any, end: Any) -> DataFrame:
    """Entries from ``start`` to ``end``, both included; a text time that does not parse
    leaves its entry out."""
    at = F.col(time_column)
    if isinstance(log.schema[time_column].dataType, T.StringType):
        at = F.try_to_timestamp(time_column).cast("timestamp_ntz")
    kind = "timestamp" if isinstance(log.schema[time_column].dataType, T.TimestampType) else "timestamp_ntz"
    return log.where(at.between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def latest_entries(log: DataFrame, limit: int, order: Sequence[Column]) -> DataFrame:
    """The most recent entries: Spark keeps only ``limit`` rows per task."""
    return log.orderBy(*order).limit(limit)


def history_summary(log: DataFrame, by: Sequence[str], initial: Column) -> DataFrame:
    """Entries, changes and first extractions per table, most changes first."""
    first = F.count_if(initial)
    total = F.count(F.lit(1))
    grouped = log.groupBy(*by).agg(
        (total - first).alias("total_changes"), first.alias("initial_extractions"), total.alias("total_entries")
    )
    return grouped.orderBy(F.desc("total_changes"), *by)
