"""Registered queries against their SQL; WICKFRAME_ALL=1 runs every one of them."""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as e

FAST = (
    "upsert_candles", "cleaning_report", "drawdown", "macd", "engineer_features", "time_series_folds", "value_at_risk",
    "symbol_correlation", "quantile_forecast", "stream_bars",
)


def test_registry():
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 120 and len(e.oracle_sql()) > 100


def test_entry(spark):
    assert e.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(e.queries()) if os.environ.get("WICKFRAME_ALL") else FAST)
def test_query(spark, sf, name):
    status, got, want = compare(spark, duck(sf), sf, name, e.queries()[name], e.oracle_sql().get(name))
    assert status == "ok" or status.startswith("rows"), (status, got, want)
