"""The registered corpus queries: oracles, guards, and plans without Python where asked for."""

from __future__ import annotations

import re
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from tests.conftest import plan_of
from tests.oracle import compare

NATIVE = ["op1_chat_formatting", "op2_exact_dedup", "op6_line_dedup", "op10_benchmark_decontamination"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_query_matches_oracle_without_python(spark, con, sf, name):
    df = driver.queries()[name](spark, sf)
    plan = plan_of(df)
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert compare(df, con, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_source_mixing", "op13_merkle_manifest"])
def test_query_matches_oracle(spark, con, sf, name):
    df = driver.queries()[name](spark, sf)
    assert not re.search("Cartesian|NestedLoop", plan_of(df))
    assert compare(df, con, driver.oracle_sql()[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = driver.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_the_rest_imports_without_this_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('pitsync.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.modules.pop('corpus_pipeline'); sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as d\n"
        "assert len(d.queries()) > 100 and not any(n.startswith('op') and n[2].isdigit() for n in d.queries())\n"
        "assert 'pipeline' not in d.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
