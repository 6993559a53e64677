"""Every query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import checks
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = checks.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "timestamp"


def test_no_python_in_any_plan(spark, plan):
    for name in sorted(QUERIES):
        text = plan(QUERIES[name](spark, SF_DIR))
        for node in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "CartesianProduct"):
            assert node not in text, (name, node)
