"""Every registered query against its SQL oracle, and the shape of its plan."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from pitsync.plans.registry import QUERIES
from tests.conftest import plan_of
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


#: Python derives keys for the salts of sealed files, see functions.secrets
WITH_PYTHON = {"sealed_files"}  # sealed_sync writes its frames by Arrow, but returns its target


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    oracle = driver.oracle_sql()
    df = driver.queries()[name](spark, FOLDER)
    plan = plan_of(df)
    for node in ("CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    python = [n for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups") if n in plan]
    assert not python or name in WITH_PYTHON
    if name in oracle:
        assert compare(df, con, oracle[name]) is None
    else:
        assert df.count() >= 0


def test_entry_is_lazy_and_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns[-1] == "month_end"
    assert df.limit(1).count() == 1
