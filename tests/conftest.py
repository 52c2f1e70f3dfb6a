from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitsync.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "pitsync-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def plan_of(df) -> str:
    """The physical plan as Spark would explain it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows(df, *order):
    order = order or df.columns
    return [tuple(r) for r in df.orderBy(*order).collect()]
