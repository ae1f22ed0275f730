"""Every registered query against its SQL, on whole small tables."""

import pytest
from check_oracle import compare, database

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_oracle(spark, con, key):
    _, problem = compare(spark, con, SF_DIR, QUERIES[key], ORACLES[key])
    assert problem is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, key):
    assert QUERIES[key](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
