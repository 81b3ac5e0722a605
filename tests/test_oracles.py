"""Every query with check SQL, row by row, on the smallest sample."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_rows_match(name, spark, con):
    df = entry_points.queries()[name](spark, FOLDER)
    assert differences(df, con, entry_points.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "total_sales" in df.columns and df.count() > 0
