"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "minute", "key", "votes", "cumulative_votes"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    difference = compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
