"""Every query that SQL can express gives the same rows as its SQL."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SMALL

import __spark_entry__ as entry_point


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_same_rows(spark, con, name):
    columns, rows = spark_rows(entry_point.queries()[name](spark, SMALL))
    want_columns, want = sql_rows(con, entry_point.oracle_sql()[name])
    assert columns == want_columns
    assert rows == want


SLICED = (
    "returns", "return_statistics", "var_cvar", "tracking_error", "risk_report", "drawdown",
    "portfolio_var", "rolling_correlation", "var_backtest", "stress_test", "stream_returns",
)


@pytest.mark.parametrize("name", SLICED)
def test_same_rows_when_cut_into_slices(sliced, con, name):
    _, rows = spark_rows(entry_point.queries()[name](sliced, SMALL))
    assert rows == sql_rows(con, entry_point.oracle_sql()[name])[1]


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
