"""Every named query runs on the smallest tables, and equals its SQL where it has one."""

import pytest

import __spark_entry__ as entry

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
ENTRY_COLUMNS = [
    "item_id", "uid", "history", "label", "hist_len", "split", "user_channel", "item_channel", "item_duration",
]


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    assert compare(spark, db, FOLDER, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ENTRY_COLUMNS
    assert df.count() > 0
