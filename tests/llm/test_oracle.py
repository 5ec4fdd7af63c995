"""The registered queries that SQL can express, on whole tables."""

import pytest

from oracle_check import SPARK_TYPES, compare, connect
from waybill.llm import queries

SPARK_TYPES["timestamp"] = "TIMESTAMP"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, sf_dir, con, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE[name]) > 0
