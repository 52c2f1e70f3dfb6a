"""Reading the source of a table spec."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from pitsync.functions.ordering import OrderKey, order_columns
from pitsync.spec import TableSpec


def parquet_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Lazy frames over ``folder/<name>.parquet``."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def scan(spark: SparkSession, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A named table: one of ``tables`` or else a catalog table."""
    return tables[name] if name in tables else spark.table(name)


def read_source(spark: SparkSession, spec: TableSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The spec's table, or its source query with ``{table}`` standing for that table.

    Other ``{name}`` holes of the query stand for other tables of ``tables``. Filters and
    marks applied later see the query's output columns, as around a subquery.
    """
    base = scan(spark, tables, spec.source)
    if not spec.source_query:
        return base
    holes = {n: df for n, df in tables.items() if f"{{{n}}}" in spec.source_query}
    return spark.sql(spec.source_query, **{**holes, "table": base})


def ordered(df: DataFrame, order: Sequence[OrderKey]) -> DataFrame:
    """Globally sorted rows: Spark range-partitions, then sorts each partition."""
    return df.orderBy(*order_columns(order))
