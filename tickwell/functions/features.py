"""Derived columns of a window feature row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def volatility_regime(deviation: Column) -> Column:
    """Fixed limits in price units; an unknown deviation counts as normal."""
    return F.when(deviation > 2.0, "high").when(deviation < 0.5, "low").otherwise("normal")


def direction_target(momentum: Column) -> Column:
    return F.when(momentum > 0.5, 1.0).when(momentum < -0.5, 0.0).otherwise(0.5)


def derive_features(windows: DataFrame) -> DataFrame:
    close, start = F.col("period_close"), F.col("period_open")
    high, low = F.col("period_high"), F.col("period_low")
    momentum = percent(close - start, start)
    return windows.withColumns(
        {
            "price_momentum": momentum,
            "intraday_volatility": percent(high - low, F.col("avg_price")),
            "price_position": F.try_divide(close - low, high - low),
            "volume_proxy": F.col("data_points"),
            "bollinger_position": F.try_divide(
                close - F.col("avg_price"), F.col("price_volatility")
            ),
            "trend_strength": F.abs(momentum) * F.col("data_points"),
            "volatility_regime": volatility_regime(F.col("price_volatility")),
            "target_direction": direction_target(momentum),
        }
    )
