"""Training, scoring and validation jobs over a feature table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.config import GATES, Gates
from tickwell.operators import drift, isolation, models
from tickwell.operators.windows import latest_features
from tickwell.sources.durable import cut


@dataclass(frozen=True)
class Trained:
    features: list[str]
    forests: DataFrame
    limits: DataFrame
    direction: models.Models
    volatility: models.Models
    regimes: models.Regimes | None
    #: Figures of the training by (symbol, kind of model).
    metrics: Mapping[tuple[str, str], Mapping[str, float]] = field(default_factory=dict)
    #: Rows of the feature table, its first and its last window.
    coverage: tuple[int, str | None, str | None] = (0, None, None)


def figures(scored: DataFrame, kind: str, fitted: models.Models) -> dict:
    """The figures of each model; a model of all symbols lists them symbol by symbol.

    `scored` has one row per symbol that was trained on.
    """
    found: dict[tuple[str, str], dict[str, float]] = {}
    for row in scored.collect():
        values = row.asDict()
        symbol = values.pop("symbol")
        pooled = symbol not in fitted
        held = found.setdefault(("*" if pooled else symbol, kind), {})
        tail = f":{symbol}" if pooled else ""
        held.update({name + tail: float(v) for name, v in values.items() if v is not None})
    return found


def train(
    table: DataFrame,
    scope: models.Scope,
    symbols: tuple[str, ...],
    target: str = "same",
    gates: Gates = GATES,
) -> Trained | None:
    """All models of one feature table; None when it has too few rows.

    `table` is read many times and should be stored; `rows` derived from it is kept in
    memory or on disk while the fits run.
    """
    first, last = F.min("window_start").cast("string"), F.max("window_start").cast("string")
    coverage = tuple(table.agg(F.count("*"), first, last).first())
    if coverage[0] < gates.batch:
        return None
    features = models.available_features(table, gates)
    # A later volatility must not be predicted from a feature that is the target itself.
    swing_features = [f for f in features if target == "same" or f != "intraday_volatility"]
    rows = models.training_rows(table, target, gates).persist()
    try:
        # Node and limit tables are model state: stored once, not regrown by each reader.
        forests = cut(isolation.grow_forests(rows, features))
        scored = isolation.anomaly_scores(rows, forests, features)
        direction = models.fit_direction(rows, features, scope, gates)
        volatility = models.fit_volatility(rows, swing_features, scope, gates)
        metrics = {}
        if direction:
            metrics |= figures(models.direction_accuracy(rows, direction), "direction", direction)
        if volatility:
            metrics |= figures(models.volatility_r2(rows, volatility), "volatility", volatility)
        return Trained(
            features,
            forests,
            cut(isolation.cutoffs(scored)),
            direction,
            volatility,
            models.fit_regimes(table, symbols, gates),
            metrics,
            coverage,
        )
    finally:
        rows.unpersist()


def predict(table: DataFrame, trained: Trained) -> DataFrame:
    """What the models say of the newest row of each symbol, and the regime of the market."""
    latest = latest_features(table)
    ready = latest.select(
        "symbol",
        "window_start",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in trained.features],
    )
    flagged = isolation.flag_anomalies(
        isolation.anomaly_scores(ready, trained.forests, trained.features), trained.limits
    )
    said = models.predictions(
        latest, trained.features, flagged, trained.direction, trained.volatility
    )
    now = None
    if trained.regimes is not None:
        # One row: the newest window has one regime.
        now = models.current_regime(table, trained.regimes).first()
    return said.withColumn("regime", F.lit(now and now["regime"]).cast("string"))


def held_out_accuracy(rows: DataFrame, fitted: models.Models) -> float | None:
    """Share of right directions over all rows held out of training; None without any."""
    if not fitted:
        return None
    by_symbol = models.direction_accuracy(rows, fitted)
    weighted = F.sum(F.col("tested") * F.col("accuracy"))
    return by_symbol.agg(F.try_divide(weighted, F.sum("tested"))).first()[0]


def not_worse(rows: DataFrame, challenger: Trained, champion: Trained) -> bool:
    """Whether the challenger is right at least as often on the rows that neither was trained on.

    Rows are held out by their content, so they are the same for every version. Only symbols that both
    have a model for count; a challenger that lacks one of the champion's symbols is worse.
    """
    if champion.direction.keys() - challenger.direction.keys():
        return False
    common = {s: m for s, m in challenger.direction.items() if s in champion.direction}
    new, old = held_out_accuracy(rows, common), held_out_accuracy(rows, champion.direction)
    return old is None or (new is not None and new >= old)


def cross_validate(
    table: DataFrame, scope: models.Scope, folds: int = 4, gates: Gates = GATES
) -> DataFrame:
    """Accuracy on each fold of a model fitted on the folds before it, next-window target."""
    features = models.available_features(table, gates)
    rows = drift.with_folds(models.training_rows(table, "next", gates), folds).persist()
    results = []
    for fold in range(2, folds + 1):
        fitted = models.fit_direction(rows.where(F.col("fold") < fold), features, scope, gates)
        scored = models.apply_models(rows.where(F.col("fold") == fold), fitted)
        if scored is not None:
            hit = (F.col("prediction") == F.col("direction_label")).cast("double")
            results.append(
                scored.groupBy("symbol", "fold").agg(
                    F.count("*").alias("tested"), F.round(F.avg(hit), 6).alias("accuracy")
                )
            )
    return reduce(DataFrame.unionByName, results)
