"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    verdict, note = compare.compare(spark, con, SF, name, entry.queries()[name], sql)
    # What SQL can't express has tests of its own against brute force; here it must run, with rows and distinct column names.
    assert verdict == ("rows" if sql is None else "ok"), note
    assert sql is not None or not note.startswith("0 ")


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
