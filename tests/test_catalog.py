"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    assert compare(spark, duck, name, data) is None


def test_registry():
    assert set(QUERIES) == set(contract.queries()) - set(contract.TEXT_QUERIES)
    assert set(contract.oracle_sql()) - set(contract.TEXT_ORACLE) == set(ORACLE) == set(QUERIES) - WITHOUT_SQL


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.segment_id for r in rows] == list(range(10))
