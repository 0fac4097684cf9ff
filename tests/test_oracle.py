"""Every registered query runs, and equals its SQL where it has one."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "match_id"


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    statement = entry.oracle_sql().get(name)
    if statement is None:
        assert df.count() > 0
    else:
        assert compare(df, con, statement) is None
