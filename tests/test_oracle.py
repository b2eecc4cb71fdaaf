"""Every query with an SQL definition, against that SQL."""

import os

import compare
import pytest

import __spark_entry__ as entry

FOLDER = f"/root/testdata/sf{os.environ.get('LAPSEWISE_TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, connection, name):
    names, want = compare.sql_rows(connection, entry.oracle_sql()[name])
    got_names, got = compare.spark_rows(entry.queries()[name](spark, FOLDER))
    assert got_names == names
    assert got == want, compare.differences(want, got)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_has_rows(spark, name):
    assert not entry.queries()[name](spark, FOLDER).isEmpty()
