"""Returns, value at risk, tracking error and correlation by hand-worked cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwell.operators.correlation import correlation, tiled
from tickwell.operators.ordered import ordered
from tickwell.operators.returns import return_statistics, returns, tracking_error
from tickwell.operators.tail_risk import var_cvar
from tickwell.plans.risk import risk_document, risk_metrics
from tickwell.config import Universe


def prices_from(returns_pct, start=100.0):
    values = [start]
    for r in returns_pct:
        values.append(values[-1] * (1 + r / 100))
    return values


def series_of(spark, values, symbol="A"):
    rows = [(symbol, i, float(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "symbol string, event_id bigint, returns double")
    return ordered(frame, "symbol", ("event_id",))


def expected_tail(values, level):
    ranked = sorted(values)
    at = min(int((1 - level) * len(ranked)), len(ranked) - 1)
    return abs(ranked[at]), abs(sum(ranked[: at + 1]) / (at + 1))


@pytest.mark.parametrize("n,at95,at99", [(10, 0, 0), (20, 1, 0), (100, 5, 1)])
def test_var_index(spark, n, at95, at99):
    values = [float(v) for v in range(-n // 2, n - n // 2)]
    random.Random(n).shuffle(values)
    row = var_cvar(series_of(spark, values)).first()
    ranked = sorted(values)
    assert row["var_95"] == abs(ranked[at95])
    assert row["var_99"] == abs(ranked[at99])
    assert row["cvar_95"] == round(abs(np.mean(ranked[: at95 + 1])), 4)


def test_positive_returns_give_positive_var(spark):
    row = var_cvar(series_of(spark, range(1, 21))).first()
    assert (row["var_95"], row["cvar_95"]) == (2.0, 1.5)


def test_too_few_returns_are_left_out(spark):
    assert var_cvar(series_of(spark, range(9))).count() == 0
    assert var_cvar(series_of(spark, range(10))).count() == 1


def hard_values(kind, size=700):
    draw = random.Random(kind)
    if kind == "ties":
        return [-3.0 if draw.random() < 0.4 else draw.gauss(0, 1) for _ in range(size)]
    if kind == "constant":
        return [0.25] * size
    if kind == "tiny":
        return [draw.gauss(0, 1e-8) for _ in range(size)]
    if kind == "huge":
        return [draw.gauss(0, 1) * 10 ** draw.randrange(-3, 7) for _ in range(size)]
    return [draw.gauss(0, 2) for _ in range(size)]


@pytest.mark.parametrize("kind", ["normal", "ties", "constant", "tiny", "huge"])
def test_selection_equals_ranking(spark, kind):
    values = hard_values(kind)
    both = series_of(spark, values).drop_slices().unionByName(series_of(spark, values[:10], "B").drop_slices())
    found = var_cvar(ordered(both, "symbol", ("event_id",)), (0.95, 0.99), 10, 9)
    chosen = {r["symbol"]: r for r in found.collect()}
    assert chosen.keys() == {"A", "B"}
    for symbol, part in (("A", values), ("B", values[:10])):
        for level, tag in ((0.95, "95"), (0.99, "99")):
            var, cvar = expected_tail(part, level)
            row = chosen[symbol]
            assert math.isclose(row[f"var_{tag}"], var, rel_tol=1e-6, abs_tol=2e-9)
            assert math.isclose(row[f"cvar_{tag}"], cvar, rel_tol=1e-6, abs_tol=2e-9)


def test_returns_bridge_null_prices_and_skip_zero_prices(price_frame):
    rows = [("A", 1, 100.0), ("A", 2, None), ("A", 3, 110.0), ("A", 4, 0.0), ("A", 5, 50.0),
            ("A", 6, 55.0)]
    got = returns(price_frame(rows)).frame.orderBy("event_id").select("event_id", "returns")
    assert [(r[0], round(r[1], 9)) for r in got.collect()] == [(2, 10.0), (3, -100.0), (5, 10.0)]


def test_rows_with_other_nulls_are_dropped_after_the_return(spark, price_frame):
    rows = [("A", 1, 100.0), ("A", 2, 110.0), ("A", 3, 121.0)]
    frame = price_frame(rows).withColumn("score", F.when(F.col("event_id") != 1, 0.0))
    got = returns(frame).frame.collect()
    assert [(r["event_id"], round(r["returns"], 9)) for r in got] == [(2, 10.0)]


def test_ties_in_time_follow_the_tick_number(price_frame):
    rows = [("A", 1, 100.0), ("A", 1, 200.0), ("A", 1, 100.0)]
    got = returns(price_frame(rows)).frame.orderBy("event_id").collect()
    assert [r["returns"] for r in got] == [100.0, -50.0]


def two_series(price_frame, base_count, other_count):
    draw = random.Random(7)
    base = prices_from([draw.gauss(0, 1) for _ in range(base_count)])
    other = prices_from([draw.gauss(0, 1) for _ in range(other_count)])
    rows = [("BASE", t, p) for t, p in enumerate(base)]
    rows += [("A", 1000 + t, p) for t, p in enumerate(other)]
    return price_frame(rows), base, other


def pct(prices):
    return [(b / a - 1) * 100 for a, b in zip(prices, prices[1:])]


def test_tracking_error_aligns_from_the_end(price_frame):
    frame, base, other = two_series(price_frame, 30, 12)
    row = tracking_error(returns(frame), "BASE").first()
    b, o = pct(base)[-12:], pct(other)
    want = np.std(np.array(o) - np.array(b), ddof=1)
    assert (row["symbol"], row["aligned"]) == ("A", 12)
    assert row["tracking_error"] == pytest.approx(want, abs=1e-4)


def test_tracking_error_is_zero_for_a_short_benchmark(price_frame):
    frame, _, _ = two_series(price_frame, 9, 30)
    assert tracking_error(returns(frame), "BASE").first()["tracking_error"] == 0.0


def test_no_benchmark_no_tracking_error(price_frame):
    frame, _, _ = two_series(price_frame, 30, 30)
    assert tracking_error(returns(frame), "OTHER").count() == 0
    report = risk_metrics(frame, Universe(("A", "BASE"), "OTHER"))
    assert {r["tracking_error"] for r in report.collect()} == {None}


def test_benchmark_has_no_tracking_error_of_its_own(price_frame):
    frame, _, _ = two_series(price_frame, 30, 30)
    report = {r["symbol"]: r for r in risk_metrics(frame, Universe(("A", "BASE"), "BASE")).collect()}
    assert report["BASE"]["tracking_error"] is None
    assert report["A"]["tracking_error"] > 0


def test_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 11.0]
    row = return_statistics(series_of(spark, values).frame).first()
    assert row["mean_return"] == 5.6
    assert row["volatility"] == round(float(np.std(values, ddof=1)), 4)
    assert (row["min_return"], row["max_return"], row["data_points"]) == (1.0, 11.0, 10)


def wide_rows(spark, symbols, times=30, seed=3):
    draw = random.Random(seed)
    rows = [
        (s, t, draw.gauss(0, 1) if s != "FLAT" else 0.0)
        for s in symbols
        for t in range(times)
        if draw.random() < 0.8
    ]
    return spark.createDataFrame(rows, "symbol string, t bigint, returns double")


def test_correlation_zero_fills_and_is_null_for_a_constant(spark):
    symbols = ["A", "B", "FLAT"]
    rows = wide_rows(spark, symbols)
    got = {
        (r["symbol_a"], r["symbol_b"]): r["corr"]
        for r in correlation(rows, "t", "returns", symbols).collect()
    }
    pdf = rows.toPandas().pivot_table(index="t", columns="symbol", values="returns").fillna(0)
    want = pdf.corr()
    for (a, b), value in got.items():
        expected = want.loc[a, b]
        if np.isnan(expected):
            assert value is None
        else:
            assert value == pytest.approx(expected, abs=1e-6)
        assert value == got[(b, a)]
    assert len(got) == 9


def same_matrix(one, two):
    one, two = ({tuple(r)[:2]: r["corr"] for r in m.collect()} for m in (one, two))
    assert one.keys() == two.keys()
    for pair, value in one.items():
        assert two[pair] == (None if value is None else pytest.approx(value, abs=2e-6)), pair


@pytest.mark.parametrize("ordered_pairs", [True, False])
@pytest.mark.parametrize("tile,times", [(2, 7), (64, 8192), (1, 1000)])
def test_tiles_give_what_expressions_give(spark, tile, times, ordered_pairs):
    symbols = ["A", "B", "FLAT", "NONE"]
    rows = wide_rows(spark, symbols[:3])
    nulls = spark.createDataFrame([("A", 10_000, None), ("OTHER", 10_001, 5.0)], rows.schema)
    rows = rows.unionByName(nulls)
    same_matrix(
        correlation(rows, "t", "returns", symbols, ordered_pairs),
        tiled(rows, "t", "returns", symbols, ordered_pairs, tile=tile, times=times),
    )


def test_tiles_keep_the_digits_of_large_values(spark):
    draw = random.Random(5)
    rows = [(s, t, base + draw.random()) for s, base in (("A", 1e9), ("B", -1e9), ("C", 0.1)) for t in range(60)]
    rows += [("FLAT", t, 0.1) for t in range(60)]
    frame = spark.createDataFrame(rows, "symbol string, t int, returns double")
    symbols = ["A", "B", "C", "FLAT"]
    same_matrix(correlation(frame, "t", "returns", symbols), tiled(frame, "t", "returns", symbols, tile=3, times=11))


def test_tiles_of_no_rows(spark):
    frame = spark.createDataFrame([], "symbol string, t int, returns double")
    rows = tiled(frame, "t", "returns", ["A", "B"]).collect()
    assert len(rows) == 4 and all(r["corr"] is None for r in rows)


def test_correlation_of_three_hundred_symbols(spark):
    symbols = [f"S{i:03d}" for i in range(300)]
    values = np.random.default_rng(3).normal(size=(50, 300))
    values[:, 7] = values[:, 200] * 2 + 1
    values[5:9, 100:180] = 0.0
    frame = spark.createDataFrame(
        [(symbols[j], t, float(values[t, j])) for t in range(50) for j in range(300) if values[t, j] != 0.0],
        "symbol string, t int, returns double",
    )
    got = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in correlation(frame, "t", "returns", symbols).collect()}
    want = np.corrcoef(values.T)
    assert len(got) == 300 * 300
    assert all(abs(got[a, b] - want[i, j]) < 1e-6 for i, a in enumerate(symbols) for j, b in enumerate(symbols))


def test_report_document(spark, price_frame, tmp_path):
    from datetime import datetime

    from tickwell.sources.reports import write_backup, write_report

    frame, _, _ = two_series(price_frame, 30, 30)
    now = datetime(2024, 5, 6, 7, 8, 9)
    document = risk_document(frame, Universe(("A", "BASE"), "BASE"), now)
    row = document.first()
    assert row["document_id"] == "risk_metrics_20240506_070809"
    assert row["month"] == "2024-05"
    assert set(row["metrics"]) == {"A", "BASE"}
    assert row["metrics"]["A"]["statistics"]["data_points"] == 30
    assert row["correlation_matrix"]["A"]["A"] == 1.0
    write_report(document, str(tmp_path / "risk"))
    write_backup(document, str(tmp_path / "backup"))
    assert spark.read.json(str(tmp_path / "risk")).where("month = '2024-05'").count() == 1
    assert spark.read.json(str(tmp_path / "backup")).count() == 1
