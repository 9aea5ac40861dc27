"""Model gates, names, repeatability and the isolation forest."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tickwell.config import MODEL_FEATURES
from tickwell.operators import drift, isolation, models
from tickwell.operators.windows import valid_quotes, window_features
from tickwell.sources import tables
from tickwell.sources.tables import EVENT_UNIVERSE as U


@pytest.fixture(scope="module")
def features(spark):
    quotes = valid_quotes(tables.quotes(spark, SMALL), U.symbols)
    return window_features(quotes, length="6 hours").persist()


def synthetic(spark, counts, up=lambda i: i % 2):
    rows = [
        (s, i, *[float((i * (k + 3)) % 7 - 3) if k else (1.0 if up(i) else -1.0) for k in range(5)])
        for s, n in counts.items()
        for i in range(n)
    ]
    columns = ", ".join(f"{f} double" for f in MODEL_FEATURES)
    return spark.createDataFrame(rows, f"symbol string, window_start bigint, {columns}")


def test_training_rows_gate_and_fill(spark):
    frame = synthetic(spark, {"A": 5, "B": 4}).withColumn("price_position", F.lit(None).cast("double"))
    rows = models.training_rows(frame)
    assert {r["symbol"] for r in rows.collect()} == {"A"}
    assert rows.where("price_position = 0").count() == 5


def test_too_few_features(spark):
    with pytest.raises(ValueError):
        models.training_rows(spark.createDataFrame([("A", 1, 1.0)], "symbol string, window_start int, price_momentum double"))


def test_direction_needs_rows_and_two_classes(spark):
    frame = models.training_rows(
        synthetic(spark, {"A": 40, "B": 7}).unionByName(synthetic(spark, {"C": 40}, up=lambda i: 1))
    )
    assert set(models.fit_direction(frame, MODEL_FEATURES, models.PerSymbol(("A", "B", "C")))) == {"A"}


def test_volatility_needs_six_rows(spark):
    frame = models.training_rows(synthetic(spark, {"A": 6, "B": 5}))
    assert set(models.fit_volatility(frame, MODEL_FEATURES, models.PerSymbol(("A", "B")))) == {"A"}


def test_next_target_looks_one_window_ahead(spark):
    rows = models.training_rows(synthetic(spark, {"A": 6}), target="next").orderBy("window_start").collect()
    assert [r["direction_label"] for r in rows] == [1.0, 0.0, 1.0, 0.0, 1.0]


def test_next_target_keeps_windows_before_a_null_volatility(spark):
    frame = synthetic(spark, {"A": 6}).withColumn(
        "intraday_volatility", F.when(F.col("window_start") != 3, F.col("intraday_volatility"))
    )
    rows = models.training_rows(frame, target="next").orderBy("window_start").collect()
    assert [r["window_start"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[2]["volatility_label"] == 0.0 and rows[2]["direction_label"] == 1.0


def test_split_does_not_depend_on_partitioning(spark, features):
    rows = models.training_rows(features)
    one = {tuple(r) for r in rows.coalesce(1).where(models.in_training()).select("symbol", "window_start").collect()}
    two = {tuple(r) for r in rows.repartition(7).where(models.in_training()).select("symbol", "window_start").collect()}
    assert one == two
    assert 0.5 < len(one) / rows.count() < 0.9


@pytest.mark.parametrize("down,up,word", [(0.4, 0.6, "NEUTRAL"), (0.39, 0.61, "UP"), (0.61, 0.39, "DOWN")])
def test_direction_words(spark, down, up, word):
    frame = spark.createDataFrame([(Vectors.dense([down, up]),)], ["probability"])
    row = frame.withColumns(models.direction_words()).first()
    assert row["direction"] == word and row["confidence"] == max(down, up)


def test_regime_names_follow_momentum():
    assert models.regime_names([[3.0, 1.0], [-2.0, -2.0], [0.0, 0.1]]) == ("Bull", "Bear", "Neutral")


def test_regimes_need_symbols_and_periods(spark):
    assert models.fit_regimes(synthetic(spark, {"A": 30}), ("A", "B")) is None
    assert models.fit_regimes(synthetic(spark, {"A": 2, "B": 2}), ("A", "B")) is None


def test_regimes(spark, features):
    fitted = models.fit_regimes(features, U.symbols, starts=3)
    again = models.fit_regimes(features, U.symbols, starts=3)
    counts = models.regime_counts(features, fitted).collect()
    assert sum(r["windows"] for r in counts) == features.select("window_start").distinct().count()
    assert sorted(map(tuple, counts)) == sorted(map(tuple, models.regime_counts(features, again).collect()))
    assert models.current_regime(features, fitted).count() == 1


def test_pooled_and_per_symbol_scores(spark, features):
    rows = models.training_rows(features)
    for scope in (models.PerSymbol(U.symbols), models.Pooled()):
        fitted = models.fit_direction(rows, MODEL_FEATURES, scope)
        scores = models.direction_accuracy(rows, fitted).collect()
        assert {r["symbol"] for r in scores} == set(U.symbols)
        assert all(0 <= r["accuracy"] <= 1 for r in scores)
    named = models.feature_importance(rows, models.fit_direction(rows, MODEL_FEATURES, models.PerSymbol(U.symbols)), MODEL_FEATURES)
    total = named.groupBy("symbol").agg(F.sum("importance").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in total)


def test_missing_models_leave_nulls(spark):
    latest = synthetic(spark, {"A": 1}).withColumn("period_close", F.lit(1.0))
    row = models.predictions(latest, MODEL_FEATURES, None, {}, {}).first()
    assert (row["anomaly"], row["direction"], row["confidence"], row["volatility_forecast"]) == (None,) * 4


# --- isolation forest ---------------------------------------------------------------------


def test_mean_path():
    assert isolation.mean_path(1) == 0 and isolation.mean_path(2) == 1
    assert float(isolation.mean_path(256)) == pytest.approx(2 * (math.log(255) + np.euler_gamma) - 2 * 255 / 256)


def walk(nodes, point):
    at = 0
    while nodes[at]["feature"] >= 0:
        node = nodes[at]
        at = node["left"] if point[node["feature"]] <= node["threshold"] else node["right"]
    return nodes[at]["length"]


def test_vectorised_paths_equal_a_walk():
    draw = np.random.default_rng(5)
    sample = draw.normal(size=(200, 3))
    frames = []
    for tree in range(4):
        nodes = pd.DataFrame(isolation.grow(sample, tree), columns=["node", "feature", "threshold", "left", "right", "length"])
        frames.append(nodes.assign(tree=tree))
    forest = pd.concat(frames)
    points = draw.normal(size=(50, 3)) * 2
    want = [
        np.mean([walk({r["node"]: r for r in f.to_dict("records")}, p) for f in frames]) for p in points
    ]
    assert isolation.path_lengths(points, forest) == pytest.approx(want)


def outlier_rows(spark, size=400):
    draw = random.Random(11)
    rows = [("A", i, draw.gauss(0, 1), draw.gauss(0, 1)) for i in range(size)]
    rows += [("A", size + i, 12.0 + i, -12.0 - i) for i in range(4)]
    rows += [("B", i, draw.gauss(0, 1), draw.gauss(0, 1)) for i in range(30)]
    return spark.createDataFrame(rows, "symbol string, window_start bigint, x double, y double")


def test_isolation_forest_finds_outliers_and_repeats(spark):
    rows = outlier_rows(spark)
    results = []
    for parts in (1, 6):
        forests = isolation.grow_forests(rows.repartition(parts), ("x", "y"))
        scored = isolation.anomaly_scores(rows, forests, ("x", "y")).persist()
        flagged = isolation.flag_anomalies(scored, isolation.cutoffs(scored))
        results.append(sorted((r["symbol"], r["window_start"], r["anomaly_score"]) for r in scored.collect()))
        top = scored.where("symbol = 'A'").orderBy(F.desc("anomaly_score")).limit(4).collect()
        assert {r["window_start"] for r in top} == {400, 401, 402, 403}
        counts = {r["symbol"]: r for r in isolation.anomaly_counts(flagged).collect()}
        assert counts["A"]["rows"] == 404 and counts["A"]["anomalies"] in range(38, 43)
        assert counts["B"]["anomalies"] == 3
    assert results[0] == results[1]


def test_scoring_in_small_groups_gives_the_same_scores(spark):
    rows = outlier_rows(spark)
    forests = isolation.grow_forests(rows, ("x", "y"), trees=5).persist()
    one = isolation.anomaly_scores(rows, forests, ("x", "y"))
    many = isolation.anomaly_scores(rows, forests, ("x", "y"), group_rows=50)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


# --- drift --------------------------------------------------------------------------------


def test_stability_index(spark):
    same = [(i % 10 / 1.0, i >= 50) for i in range(100)]
    moved = [(float(i % 10) + (5 if i >= 50 else 0), i >= 50) for i in range(100)]
    low, high = (
        drift.population_stability(
            spark.createDataFrame(rows, "x double, late boolean"), ("x",), F.col("late")
        ).first()["stability_index"]
        for rows in (same, moved)
    )
    assert low == 0.0 and high > 1.0


def test_folds_expand(spark):
    rows = drift.fold_table(synthetic(spark, {"A": 10}), 3).orderBy("fold").collect()
    assert [(r["fold"], r["train_rows"], r["test_rows"]) for r in rows] == [(2, 4, 3), (3, 7, 3)]
