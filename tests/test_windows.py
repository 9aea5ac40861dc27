"""Window features on hand-made quotes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickwell.functions.features import direction_target, volatility_regime
from tickwell.operators.windows import (
    latest_features,
    next_period_target,
    valid_quotes,
    window_features,
)


@pytest.fixture
def quotes(price_frame):
    def make(rows):
        return price_frame(rows).withColumns(
            {
                "percent_change": F.lit(1.5),
                "high": F.col("current_price") + 1,
                "low": F.col("current_price") - 1,
            }
        )

    return make


def test_one_tick_window(quotes):
    row = window_features(quotes([("A", 10, 50.0)])).first()
    assert row["price_volatility"] is None and row["bollinger_position"] is None
    assert row["volatility_regime"] == "normal"
    assert (row["price_momentum"], row["target_direction"], row["data_points"]) == (0.0, 0.5, 1)
    assert (row["period_open"], row["period_close"], row["avg_return"]) == (50.0, 50.0, 1.5)
    assert row["price_position"] == 0.5


def test_flat_window_has_no_position(price_frame):
    flat = price_frame([("A", 1, 5.0), ("A", 2, 5.0)]).withColumns(
        {"percent_change": F.lit(0.0), "high": F.lit(5.0), "low": F.lit(5.0)}
    )
    row = window_features(flat).first()
    assert row["price_position"] is None
    assert row["bollinger_position"] is None
    assert row["volatility_regime"] == "low"


def test_open_and_close_follow_time_then_tick(quotes):
    rows = [("A", 30, 3.0), ("A", 10, 1.0), ("A", 30, 4.0), ("A", 10, 2.0), ("A", 20, 9.0)]
    row = window_features(quotes(rows)).first()
    assert (row["period_open"], row["period_close"]) == (1.0, 4.0)
    assert row["price_momentum"] == 300.0
    assert row["trend_strength"] == 1500.0
    assert row["min_price"] <= row["avg_price"] <= row["max_price"]


def test_windows_split_at_five_minutes(quotes):
    rows = [("A", 299, 1.0), ("A", 300, 2.0), ("B", 299, 3.0)]
    got = window_features(quotes(rows)).groupBy("symbol").count().collect()
    assert {(r["symbol"], r["count"]) for r in got} == {("A", 2), ("B", 1)}


@pytest.mark.parametrize(
    "value,target", [(0.5, 0.5), (0.51, 1.0), (-0.5, 0.5), (-0.51, 0.0), (None, 0.5)]
)
def test_direction_limits(spark, value, target):
    frame = spark.createDataFrame([(value,)], "m double")
    assert frame.select(direction_target(F.col("m"))).first()[0] == target


@pytest.mark.parametrize(
    "value,regime",
    [(2.0, "normal"), (2.01, "high"), (0.5, "normal"), (0.49, "low"), (None, "normal")],
)
def test_regime_limits(spark, value, regime):
    frame = spark.createDataFrame([(value,)], "d double")
    assert frame.select(volatility_regime(F.col("d"))).first()[0] == regime


def test_latest_and_next(quotes):
    rows = [("A", 0, 1.0), ("A", 1, 2.0), ("A", 300, 4.0), ("A", 301, 3.0)]
    features = window_features(quotes(rows))
    assert latest_features(features).first()["period_close"] == 3.0
    got = [r["next_direction"] for r in next_period_target(features).orderBy("window_start").collect()]
    assert got == [0.0, None]


def test_valid_quotes(price_frame):
    rows = [("A", 1, 0.0), ("A", 2, -1.0), ("A", 3, None), ("X", 4, 1.0), (None, 5, 1.0), ("A", 6, 1.0)]
    assert [r["event_id"] for r in valid_quotes(price_frame(rows), ("A", "B")).collect()] == [5]


def test_aggregation_stays_hash_based(quotes):
    plan = window_features(quotes([("A", 1, 1.0)]))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
