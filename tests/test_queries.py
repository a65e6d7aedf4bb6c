"""Every registered query against its SQL on the smallest supplied tables."""

from __future__ import annotations

import os

import pytest

import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.oracle(FOLDER)


def entry():
    import __spark_entry__
    return __spark_entry__


@pytest.mark.parametrize("name", sorted(entry().queries()))
def test_query(spark, con, name):
    df = entry().queries()[name](spark, FOLDER)
    sql = entry().oracle_sql().get(name)
    if sql is None:
        assert not df.isEmpty()
    else:
        assert compare.difference(df, con, sql) is None


def test_every_oracle_has_a_query():
    assert set(entry().oracle_sql()) <= set(entry().queries())


def test_entry(spark):
    assert entry().entry(spark).count() > 0
