"""Direction, volatility and market-regime models on window feature rows.

Feature rows are one per symbol and window. `PerSymbol` fits one model for each member of a
short symbol list; `Pooled` fits one model over all symbols, with the symbol as a feature,
for universes too long to loop over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.config import GATES, MODEL_FEATURES, REGIME_NAMES, Gates
from tickwell.operators.clusters import fit_clusters, nearest
from tickwell.operators.correlation import time_matrix
from tickwell.operators.ordered import ordered
from tickwell.sources.durable import broadcast_if_small

# Forest and clustering settings.
TREES, DEPTH, SEED = 20, 3, 42
CLUSTERS, STARTS = 3, 10
CONFIDENT = 0.6
FITS_AT_ONCE = 5


def available_features(rows: DataFrame, gates: Gates = GATES) -> list[str]:
    found = [name for name in MODEL_FEATURES if name in rows.columns]
    if len(found) < gates.features:
        raise ValueError(f"need {gates.features} of {MODEL_FEATURES}, found {found}")
    return found


def training_rows(rows: DataFrame, target: str = "same", gates: Gates = GATES) -> DataFrame:
    """Feature rows of symbols with enough of them, nulls as 0, with both labels.

    `target="same"` labels a row by its own window; `target="next"` by the window after it.
    """
    found = available_features(rows, gates)
    momentum, volatility = F.col("price_momentum"), F.col("intraday_volatility")
    if target == "next":
        ahead = {"_momentum": "price_momentum", "_volatility": "intraday_volatility", "_following": "window_start"}
        rows = ordered(rows, "symbol", ("window_start",)).lead(ahead).drop_slices()
        momentum, volatility = F.col("_momentum"), F.col("_volatility")
    labels = {
        "direction_label": (F.coalesce(momentum, F.lit(0.0)) > 0).cast("double"),
        "volatility_label": volatility,
    }
    labelled = rows.withColumns(labels)
    if target == "next":
        # Only a symbol's last window has none after it; a next volatility may be NULL anywhere.
        labelled = labelled.where("_following IS NOT NULL")
    sizes = rows.groupBy("symbol").agg(F.count("*").alias("rows"))
    enough = sizes.where(F.col("rows") >= gates.symbol)
    return (
        labelled.join(broadcast_if_small(enough), "symbol")
        .withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in found})
        .na.fill(0.0, ["volatility_label"])
        .select("symbol", "window_start", *found, "direction_label", "volatility_label")
    )


def in_training(seed: int = SEED):
    """Seven rows of ten, picked by content so that the split survives repartitioning."""
    return F.pmod(F.xxhash64("symbol", "window_start", F.lit(seed)), F.lit(10)) < 7


@dataclass(frozen=True)
class PerSymbol:
    symbols: tuple[str, ...]

    def stages(self, features: Sequence[str]) -> list:
        return [VectorAssembler(inputCols=list(features), outputCol="features")]

    def parts(self, rows: DataFrame) -> list[tuple[str, DataFrame]]:
        return [(s, rows.where(F.col("symbol") == s)) for s in self.symbols]


@dataclass(frozen=True)
class Pooled:
    """`symbols` stays empty: the one model serves every symbol."""

    symbols: tuple[str, ...] = ()

    def stages(self, features: Sequence[str]) -> list:
        return [
            StringIndexer(inputCol="symbol", outputCol="symbol_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="symbol_index", outputCol="symbol_vector"),
            VectorAssembler(inputCols=[*features, "symbol_vector"], outputCol="features"),
        ]

    def parts(self, rows: DataFrame) -> list[tuple[str, DataFrame]]:
        return [("*", rows)]


Scope = PerSymbol | Pooled
Models = dict[str, PipelineModel]


A, B = TypeVar("A"), TypeVar("B")


def side_by_side(fn: Callable[[A], B], items: Iterable[A], at_once: int = FITS_AT_ONCE) -> list[B]:
    """Run independent fits from several threads; each one is a chain of Spark jobs."""
    with ThreadPool(at_once) as pool:
        return pool.map(fn, items)


def fit_parts(
    fit: Callable[[DataFrame], PipelineModel | None], scope: Scope, rows: DataFrame
) -> Models:
    parts = scope.parts(rows)
    fitted = side_by_side(fit, [part for _, part in parts])
    return {name: model for (name, _), model in zip(parts, fitted) if model is not None}


def fit_direction(
    rows: DataFrame, features: Sequence[str], scope: Scope, gates: Gates = GATES
) -> Models:
    forest = RandomForestClassifier(
        labelCol="direction_label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )

    def fit(part: DataFrame) -> PipelineModel | None:
        seen = part.agg(
            F.count("*").alias("rows"), F.count_distinct("direction_label").alias("classes")
        ).first()
        if seen["rows"] < gates.direction or seen["classes"] < 2:
            return None
        pipeline = Pipeline(stages=[*scope.stages(features), forest])
        return pipeline.fit(part.where(in_training()))

    return fit_parts(fit, scope, rows)


def fit_volatility(
    rows: DataFrame, features: Sequence[str], scope: Scope, gates: Gates = GATES
) -> Models:
    forest = RandomForestRegressor(
        labelCol="volatility_label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )

    def fit(part: DataFrame) -> PipelineModel | None:
        if part.limit(gates.volatility).count() < gates.volatility:
            return None
        return Pipeline(stages=[*scope.stages(features), forest]).fit(part)

    return fit_parts(fit, scope, rows)


def apply_models(rows: DataFrame, models: Models) -> DataFrame | None:
    """Rows of every symbol that has a model, with its prediction; None without models."""
    scored = None
    for name, model in models.items():
        part = rows if name == "*" else rows.where(F.col("symbol") == name)
        result = model.transform(part)
        scored = result if scored is None else scored.unionByName(result)
    return scored


def direction_accuracy(rows: DataFrame, models: Models) -> DataFrame:
    """Share of right predictions on the rows held out of training."""
    scored = apply_models(rows.where(~in_training()), models)
    hit = (F.col("prediction") == F.col("direction_label")).cast("double")
    return scored.groupBy("symbol").agg(
        F.count("*").alias("tested"), F.round(F.avg(hit), 6).alias("accuracy")
    )


def feature_importance(rows: DataFrame, models: Models, features: Sequence[str]) -> DataFrame:
    """One row per symbol and feature, from models that are already small."""
    found = [
        (name, feature, float(model.stages[-1].featureImportances[i]))
        for name, model in models.items()
        for i, feature in enumerate(features)
    ]
    return rows.sparkSession.createDataFrame(
        found, "symbol string, feature string, importance double"
    )


def volatility_r2(rows: DataFrame, models: Models) -> DataFrame:
    """Explained share of the variance on the training rows."""
    scored = apply_models(rows, models)
    label, error = F.col("volatility_label"), F.col("volatility_label") - F.col("prediction")
    total = F.var_pop(label) * F.count("*")
    return scored.groupBy("symbol").agg(
        F.count("*").alias("rows"),
        F.round(1 - F.try_divide(F.sum(error * error), total), 6).alias("r2"),
    )


@dataclass(frozen=True)
class Regimes:
    """Centres of the momentum matrix and the name of each, by its mean momentum."""

    centres: tuple[tuple[float, ...], ...]
    symbols: tuple[str, ...]
    names: tuple[str, ...]

    def label(self, matrix: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(n) for n in self.names])
        vectors = matrix.withColumn("features", vector_of(self.symbols))
        return vectors.withColumn("prediction", nearest("features", self.centres)).withColumn(
            "regime", names[F.col("prediction")]
        )


def vector_of(symbols: Sequence[str]):
    return F.array(*[F.col(f"`{s}`") for s in symbols])


def regime_names(centers: Sequence[Sequence[float]]) -> tuple[str, ...]:
    means = [sum(c) / len(c) for c in centers]
    rank = {i: r for r, i in enumerate(sorted(range(len(means)), key=means.__getitem__))}
    return tuple(REGIME_NAMES[rank[i]] for i in range(len(means)))


def fit_regimes(
    rows: DataFrame, symbols: Sequence[str], gates: Gates = GATES, starts: int = STARTS
) -> Regimes | None:
    """Best of several k-means starts on one row per window, one momentum per symbol."""
    present = rows.agg(F.count_distinct("symbol")).first()[0]
    matrix = time_matrix(rows, "window_start", "price_momentum", symbols)
    if present < gates.cross_symbols or matrix.limit(gates.cross_periods).count() < gates.cross_periods:
        return None
    vectors = matrix.select("window_start", vector_of(symbols).alias("features"))
    centres = fit_clusters(vectors, "window_start", "features", CLUSTERS, starts, SEED).centres
    if len(centres) < CLUSTERS:
        return Regimes(centres, tuple(symbols), tuple(REGIME_NAMES[: len(centres)]))
    return Regimes(centres, tuple(symbols), regime_names(centres))


def regime_counts(rows: DataFrame, regimes: Regimes) -> DataFrame:
    matrix = time_matrix(rows, "window_start", "price_momentum", regimes.symbols)
    return regimes.label(matrix).groupBy("regime").agg(F.count("*").alias("windows"))


def current_regime(rows: DataFrame, regimes: Regimes) -> DataFrame:
    """Regime of the newest window."""
    matrix = time_matrix(rows, "window_start", "price_momentum", regimes.symbols)
    newest = matrix.orderBy(F.desc("window_start")).limit(1)
    return regimes.label(newest).select("window_start", "regime")


def direction_words(probability: str = "probability") -> dict:
    p = vector_to_array(probability)
    return {
        "direction": F.when(p[1] > CONFIDENT, "UP").when(p[0] > CONFIDENT, "DOWN").otherwise("NEUTRAL"),
        "confidence": F.array_max(p),
    }


def predictions(
    latest: DataFrame,
    features: Sequence[str],
    flagged: DataFrame | None,
    direction: Models,
    volatility: Models,
) -> DataFrame:
    """One row per symbol with what its models say; a missing model leaves NULL.

    `latest` and all inputs have one row per symbol.
    """
    ready = latest.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    )
    result = latest.select("symbol", "window_start", "period_close", "price_momentum")
    if flagged is None:
        result = result.withColumn("anomaly", F.lit(None).cast("boolean"))
    else:
        result = result.join(flagged.select("symbol", "anomaly"), "symbol", "left")
    moved = apply_models(ready, direction)
    if moved is None:
        result = result.withColumns(
            {"direction": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")}
        )
    else:
        moved = moved.withColumns(direction_words()).select("symbol", "direction", "confidence")
        result = result.join(moved, "symbol", "left")
    swings = apply_models(ready, volatility)
    if swings is None:
        return result.withColumn("volatility_forecast", F.lit(None).cast("double"))
    swings = swings.select("symbol", F.col("prediction").alias("volatility_forecast"))
    return result.join(swings, "symbol", "left")
