"""Every query outside the subpackage llm against its SQL, and what plans may not contain."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tests.compare import connect, differences
from tidemark.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]
#: Folds over sorted streams of rows, streams, and the walk over links.
PYTHON = {"greedy_spacing_windows", "top_peaks_nms", "news_anchored_windows", "superlative_check", "doc_first_of_similar"}
#: Without SQL: held against plain versions in other tests.
PLAIN = {"turns_unlike_last"}


@pytest.fixture(scope="session")
def con():
    return connect(SF)


def test_every_query_is_held_against_something():
    assert set(QUERIES) - set(ORACLE_SQL) == PLAIN


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert differences(df, con, ORACLE_SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert "InPandas" not in plan and "ArrowEvalPython" not in plan


def test_filters_reach_the_scan(spark):
    plan = QUERIES["pricing_summary"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in plan
    assert "l_orderkey" not in plan.split("ReadSchema")[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_without_the_subpackage_llm(tmp_path):
    """The rest imports and its queries are there when the subpackage and the pipeline are gone."""
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(n.startswith('op') for n in q), len(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
