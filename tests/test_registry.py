"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402
from tidemart.sources.scratch import lifetime  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    with lifetime(spark):
        problems, _ = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["year_month", "year", "month"] and df.count() == 79


def test_entry_works_without_the_optional_subpackage():
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['tidemart.llm'] = None\n"
            "import __spark_entry__ as E\n"
            "assert E.LLM_QUERIES == {} and 'monthly_global_trends' in E.queries() and set(E.oracle_sql()) == set(E.queries())\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
