"""Schemas, field contracts and thresholds shared by all jobs.

Schemas are kept as DDL strings so that a module import needs no running session.
"""

from __future__ import annotations

from dataclasses import dataclass

# The quote message layout and the field lists checked by the quality job.
QUOTE_FIELDS_10 = (
    "symbol string, current_price double, change double, percent_change double, "
    "high double, low double, open double, previous_close double, "
    "timestamp string, data_source string"
)
QUOTE_FIELDS_14 = (
    QUOTE_FIELDS_10
    + ", intraday_volatility double, intraday_range double, data_type string, doc_id string"
)
TOPIC_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
VENDOR_BODY = "c double, d double, dp double, h double, l double, o double, pc double"
VENDOR_NAMES = {
    "c": "current_price",
    "d": "change",
    "dp": "percent_change",
    "h": "high",
    "l": "low",
    "o": "open",
    "pc": "previous_close",
}
NUMBER_FIELDS = ("current_price", "change", "percent_change", "high", "low", "open")
STRING_FIELDS = ("symbol", "timestamp", "data_source")
CONTRACT_9 = (
    "symbol", "current_price", "change", "percent_change",
    "high", "low", "open", "timestamp", "data_source",
)
REQUIRED_FIELDS = ("symbol", "current_price", "timestamp")
OPTIONAL_FIELDS = ("change", "percent_change", "high", "low", "open", "previous_close")
MODEL_FEATURES = (
    "price_momentum", "intraday_volatility", "price_position", "volume_proxy", "trend_strength",
)
REGIME_NAMES = ("Bear", "Neutral", "Bull")


@dataclass(frozen=True)
class Universe:
    """The tradable symbols, in resolution priority order, and the benchmark among them."""

    symbols: tuple[str, ...]
    benchmark: str


# The symbols followed in production.
ETF = Universe(("SPY", "QQQ", "IWM"), "SPY")


@dataclass(frozen=True)
class Gates:
    """Minimum row counts below which a result is not produced."""

    returns: int = 10
    batch: int = 10
    symbol: int = 5
    direction: int = 8
    volatility: int = 6
    cross_symbols: int = 2
    cross_periods: int = 3
    features: int = 3


GATES = Gates()
