"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from matchmill.plans.queries import REGISTRY
from tests.conftest import SF_DIR
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert not compare(df, con, contract.oracle_sql()[name])


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert all(query.sql for query in REGISTRY.values())
    assert set(REGISTRY) <= set(contract.queries())
