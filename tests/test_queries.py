"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from helpers import plan
from verification import oracles, queries
from verification.compare import compare, tables

QUERIES, ORACLES = queries.REGISTRY, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_without_cross_join_or_python_rows(spark, duck, name):
    result = QUERIES[name](spark, SF)
    text = plan(result)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    # the matrix products of the correlation are the only Python in a batch query
    assert name == "return_correlation" or "InPandas" not in text
    assert compare(result, duck.execute(ORACLES[name])) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
