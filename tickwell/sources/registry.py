"""Versioned models in the shared folder, listed in a manifest once they are complete."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.operators.models import Models, Regimes
from tickwell.plans.learning import Trained
from tickwell.sources.manifest import Manifest, Version, commit, folder_exists, promote, read_manifest

__all__ = ["entries", "folder_exists", "latest_version", "load", "promote", "read_manifest", "save", "versions", "write_results"]

ENTRY = "symbol string, kind string, version bigint, path string, trained_at timestamp, metrics map<string,double>, names array<string>"
CENTRES = "regime int, centre array<double>"
VERSION = "version bigint, parent bigint, champion boolean, rows bigint, since string, until string, trained_at string"
ALL_SYMBOLS = "all"


def _folder(symbol: str) -> str:
    return ALL_SYMBOLS if symbol == "*" else symbol


def save(
    spark: SparkSession,
    trained: Trained,
    root: str,
    version: int,
    now: datetime,
    metrics: Mapping[tuple[str, str], Mapping[str, float]] | None = None,
) -> Manifest:
    """Models first, then the entry rows, then the manifest, so a version is listed only once it is complete.

    Each call has folders of its own: one that fails leaves no trace in the lists, and saving a version
    again replaces it in one step. Without `metrics` the figures of the training are listed.
    """
    attempt = f"{version}-{uuid.uuid4().hex[:12]}"
    listed = trained.metrics if metrics is None else metrics
    entries = []

    def entry(symbol: str, kind: str, path: str) -> None:
        entries.append((symbol, kind, version, path, now, dict(listed.get((symbol, kind), {})), None))

    for kind, fitted in (("direction", trained.direction), ("volatility", trained.volatility)):
        for symbol, model in fitted.items():
            path = f"{root}/models/{_folder(symbol)}/{kind}/{attempt}"
            model.write().overwrite().save(path)
            entry(symbol, kind, path)
    base = f"{root}/models/{ALL_SYMBOLS}/anomaly/{attempt}"
    trained.forests.write.mode("overwrite").parquet(f"{base}/forests")
    trained.limits.write.mode("overwrite").parquet(f"{base}/limits")
    entry("*", "anomaly", base)
    if trained.regimes is not None:
        path = f"{root}/models/market/regime/{attempt}"
        centres = [(i, list(c)) for i, c in enumerate(trained.regimes.centres)]
        spark.createDataFrame(centres, CENTRES).coalesce(1).write.mode("overwrite").parquet(path)
        entries.append(("market", "regime", version, path, now, {}, list(trained.regimes.names)))
    path = f"{root}/entries/{attempt}"
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.parquet(path)
    made = Version(version, path, now.isoformat(), *trained.coverage)
    return commit(spark, root, lambda manifest: manifest.with_version(made))


def entries(spark: SparkSession, root: str) -> DataFrame:
    """One row for each model of each listed version."""
    paths = [v.entries for v in read_manifest(spark, root).versions]
    return spark.read.schema(ENTRY).parquet(*paths) if paths else spark.createDataFrame([], ENTRY)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """One row for each listed version: where it comes from and what it was trained on."""
    manifest = read_manifest(spark, root)
    rows = [
        (v.version, v.parent, v.version == manifest.champion, v.rows, v.since, v.until, v.trained_at)
        for v in manifest.versions
    ]
    return spark.createDataFrame(rows, VERSION)


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest version, or none while nothing has been trained."""
    return read_manifest(spark, root).newest()


def load(
    spark: SparkSession, root: str, features: list[str], symbols: tuple[str, ...], version: int | None = None
) -> Trained:
    """The models of a version, the newest one unless told."""
    manifest = read_manifest(spark, root)
    wanted = manifest.newest() if version is None else version
    path = next((v.entries for v in manifest.versions if v.version == wanted), None)
    if path is None:
        raise ValueError(f"no version {wanted} in {root}")
    # One row per saved model of one version.
    listed = spark.read.schema(ENTRY).parquet(path).collect()

    def models(kind: str) -> Models:
        return {r["symbol"]: PipelineModel.load(r["path"]) for r in listed if r["kind"] == kind}

    base = next(r["path"] for r in listed if r["kind"] == "anomaly")
    regimes = None
    for row in listed:
        if row["kind"] == "regime":
            # One row for each regime.
            stored = spark.read.schema(CENTRES).parquet(row["path"]).orderBy("regime").collect()
            regimes = Regimes(tuple(tuple(r["centre"]) for r in stored), symbols, tuple(row["names"]))
    return Trained(
        features,
        spark.read.parquet(f"{base}/forests"),
        spark.read.parquet(f"{base}/limits"),
        models("direction"),
        models("volatility"),
        regimes,
    )


def write_results(
    results: DataFrame, root: str, batch_id: int, now: datetime, models_count: int
) -> None:
    """Result rows of one run with its time, batch and number of models, as JSON."""
    results.withColumns(
        {
            "timestamp": F.lit(now.isoformat()),
            "batch_id": F.lit(batch_id),
            "models_count": F.lit(models_count),
        }
    ).write.mode("overwrite").json(f"{root}/results/batch={batch_id}")
