"""Every registered query against its SQL oracle, on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_oracle(spark, database, name):
    assert mismatch(spark, database, SF_DIR, name) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 31
    assert sum(row.n_tokens for row in rows) == 496_092
    assert min(row.n_tokens for row in rows) == 4_572


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
