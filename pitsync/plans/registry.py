"""A query by name: the Spark plan and, where SQL can state it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[["Tables"], DataFrame]


class Tables:
    """Lazy access to the Parquet tables of a folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``."""

    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(name, plan, sql)
        return plan

    return add
