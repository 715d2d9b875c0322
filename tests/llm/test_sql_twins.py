"""Registered queries with a SQL twin, value by value, and their names."""

import pytest

import __spark_entry__ as registered
from seatrace.llm import registry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_all_operators_and_the_pipeline_are_registered():
    names = registered.queries()
    assert [n for n in names if n.startswith("op")] == list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, connection, name):
    found = compare(spark, connection, name, SF_DIR, registry.queries(), registry.oracle_sql())
    assert found is None
