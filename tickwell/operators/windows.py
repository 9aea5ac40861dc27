"""Tumbling-window feature rows, the same for batch and streaming quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.features import derive_features
from tickwell.operators.ordered import ordered


def valid_quotes(quotes: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    return quotes.where(
        (F.col("current_price") > 0)
        & F.col("symbol").isNotNull()
        & F.col("symbol").isin(*symbols)
    )


def arrival_key(time: str, tick: str) -> Column:
    """(time, tick) as one number.

    `min_by` over a struct falls back to a sort-based aggregate; a decimal stays in the hash
    aggregate. Ticks are non-negative and below 10**19, so the order is the struct's order.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(38,0)")
    return micros * F.expr("10000000000000000000BD") + F.col(tick)


def window_aggregates(
    quotes: DataFrame,
    time: str = "event_time",
    tick: str = "event_id",
    length: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per (tumbling window, symbol); open and close follow (time, tick)."""
    if watermark is not None:
        quotes = quotes.withWatermark(time, watermark)
    keyed = quotes.withColumn("_arrival", arrival_key(time, tick))
    return (
        keyed.groupBy(F.window(time, length).alias("window"), "symbol")
        .agg(
            F.avg("current_price").alias("avg_price"),
            F.max("current_price").alias("max_price"),
            F.min("current_price").alias("min_price"),
            F.stddev_samp("current_price").alias("price_volatility"),
            F.avg("percent_change").alias("avg_return"),
            F.count("*").alias("data_points"),
            F.max("high").alias("period_high"),
            F.min("low").alias("period_low"),
            F.min_by("current_price", "_arrival").alias("period_open"),
            F.max_by("current_price", "_arrival").alias("period_close"),
        )
        .withColumns(
            {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
        )
        .drop("window")
    )


def window_features(
    quotes: DataFrame,
    time: str = "event_time",
    tick: str = "event_id",
    length: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    return derive_features(window_aggregates(quotes, time, tick, length, watermark))


def next_period_target(features: DataFrame) -> DataFrame:
    """Direction of the following window of the symbol, NULL on its last window."""
    rows = ordered(features, "symbol", ("window_start",))
    return rows.lead({"next_direction": "target_direction"}).drop_slices()


def latest_features(features: DataFrame) -> DataFrame:
    """The newest window row of each symbol."""
    rest = [name for name in features.columns if name not in ("symbol", "window_start")]
    newest = F.max_by(F.struct(*rest), "window_start").alias("row")
    return features.groupBy("symbol").agg(
        F.max("window_start").alias("window_start"), newest
    ).select("symbol", "window_start", "row.*")
