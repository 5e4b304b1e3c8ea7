"""Every named query against its SQL twin."""

import os

import pytest

from lakestar.plans import QUERIES, SQL
from tests.oracle import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differences(spark, con, FOLDER, name) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 20
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
