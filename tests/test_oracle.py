"""Every query with an oracle gives the same columns, types, rows and values as its SQL."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare.difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert {r["split"] for r in entry(spark).collect()} == {"train", "val", "test"}
