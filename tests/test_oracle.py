"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from carelake.plans import catalog, oracle
from tests.conftest import SF0001
from tests.oracle_check import compare, duck

QUERIES = catalog.QUERIES
ORACLE = oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLE])
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF0001, key, QUERIES[key], ORACLE[key], con)
    assert r["status"] == "ok" and "types" not in r, r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["First_Name", "Total_Count"]
    assert len(df.collect()) == 10


def test_other_queries_do_not_need_the_optional_subpackage():
    """Without the subpackage (or its pipeline) the entry module still imports."""
    import subprocess
    import sys
    code = ("import sys\n"
            "class Missing:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('carelake.llm', 'corpus_pipeline'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Missing())\n"
            "import __spark_entry__ as E\n"
            "assert not [k for k in E.queries() if k.startswith('op') or k == 'pipeline'], E.queries().keys()\n"
            "assert 'gold' in E.queries() and 'gold' in E.oracle_sql()\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=E._HERE)
