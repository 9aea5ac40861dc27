"""The batch risk job: history to returns to all figures and the report document."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tickwell.config import GATES, Universe
from tickwell.operators.correlation import correlation
from tickwell.operators.returns import TIME, return_statistics, returns, tracking_error
from tickwell.operators.tail_risk import var_cvar
from tickwell.sources.reports import report_document, report_rows


def risk_metrics(prices: DataFrame, universe: Universe, min_rows: int = GATES.returns) -> DataFrame:
    """One row per symbol with at least `min_rows` returns."""
    series = returns(prices)
    return report_rows(
        return_statistics(series.frame, min_rows),
        var_cvar(series, min_rows=min_rows),
        tracking_error(series, universe.benchmark, min_rows),
    )


def risk_document(prices: DataFrame, universe: Universe, now: datetime, days: int = 30) -> DataFrame:
    series = returns(prices)
    metrics = report_rows(
        return_statistics(series.frame),
        var_cvar(series),
        tracking_error(series, universe.benchmark),
    )
    matrix = correlation(series.frame, TIME, "returns", universe.symbols)
    return report_document(metrics, matrix, now, days)
