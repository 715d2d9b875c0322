"""Every registered query with a SQL twin, value by value, at the smallest scale."""

import pytest

import __spark_entry__ as registered
import oracles
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_names_match():
    assert set(oracles.statements()) == set(registered.position_queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(oracles.statements()))
def test_equals_sql(spark, connection, name):
    found = compare(
        spark, connection, name, SF_DIR, registered.position_queries(), oracles.statements()
    )
    assert found is None


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["zone", "hour", "date"]
