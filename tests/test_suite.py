"""Every registered query against its SQL check."""

import pytest
from compare import compare, duck
from conftest import SF_DIR

from tillwork.suite import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    assert compare(QUERIES[key](spark, SF_DIR), con, ORACLES[key]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["year", "month"]
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
