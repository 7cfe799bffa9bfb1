"""Every registered query against its SQL on the smallest test tables."""

import os

import oracle_check
import pytest

import __spark_entry__ as contract

SF_DIR = f"{oracle_check.ROOT}/sf0.001"
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    query = contract.queries()[name]
    if name not in SQL:
        assert query(spark, SF_DIR).count() > 0
        return
    problem, _ = oracle_check.compare(spark, con, query, SQL[name], SF_DIR)
    assert problem is None, problem
