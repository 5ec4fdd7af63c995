"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect
from waybill.plans import catalog, oracle

QUERIES = catalog.QUERIES
ORACLE = oracle.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_same_names():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    rows = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert rows > 0
