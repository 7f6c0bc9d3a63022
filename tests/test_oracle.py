"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import importlib

import pytest

from testbed import compare, oracle, registry
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("key", registry.queries())
def test_query_equals_sql(spark, duck, key):
    assert compare.differences(spark, duck, SF_DIR, key) == []


def test_every_query_has_a_twin():
    assert registry.queries().keys() == oracle.oracle_sql().keys()


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert registry.queries().keys() <= entry.queries().keys()
    assert oracle.oracle_sql().keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
    frame = entry.entry(spark)
    assert frame.columns[0] == "complaint_month_date" and frame.count() > 0
