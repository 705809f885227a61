"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# Queries whose names don't begin with q_ come from a subpackage that has tests of its own.
QUERIES = {k: q for k, q in entry_module.queries().items() if k.startswith("q_")}
CHECKS = {k: q for k, q in entry_module.oracle_sql().items() if k.startswith("q_")}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], CHECKS[name]) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() == 1000
    assert df.schema == entry_module.entry(spark).schema
