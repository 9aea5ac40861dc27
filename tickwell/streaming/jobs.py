"""Streaming jobs: ingest, window features, and train or score on their table.

One query reads the topic and writes the feature table. Training and scoring follow that
table, so the topic is read and aggregated once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickwell.config import Universe
from tickwell.operators import models
from tickwell.operators.quality import parse_quotes
from tickwell.operators.windows import valid_quotes, window_features
from tickwell.plans import ingest, learning
from tickwell.sources import registry
from tickwell.sources.topics import as_topic_values, dead_letters

# Window, lateness and trigger settings.
WINDOW, LATENESS = "5 minutes", "10 minutes"
TRAIN_EVERY, PREDICT_EVERY, MONITOR_EVERY = "120 seconds", "90 seconds", "60 seconds"
MONITOR_COLUMNS = (
    "symbol", "price_momentum", "intraday_volatility", "trend_strength",
    "volatility_regime", "window_start",
)


def trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Processing-time trigger, or everything available now and then stop."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def arrival_number() -> Column:
    """Offset and partition as one tie-break; offsets alone repeat between partitions."""
    return (F.col("offset") * 4096 + F.col("partition")).alias("event_id")


def quote_stream(topic: DataFrame, universe: Universe, event_time: bool = False) -> DataFrame:
    """Valid quotes with the time they are windowed by: arrival, or the quote's own time.

    A quote whose own time is no timestamp falls into no window.
    """
    numbered = topic.select("*", arrival_number())
    parsed = parse_quotes(numbered, keep=("event_id",))
    time = F.try_to_timestamp("timestamp") if event_time else F.current_timestamp()
    return valid_quotes(parsed, universe.symbols).withColumn("processing_time", time)


def feature_stream(quotes: DataFrame, length: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    return window_features(quotes, "processing_time", "event_id", length, lateness)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def append_batches(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = TRAIN_EVERY, name: str | None = None
) -> StreamingQuery:
    """Each micro-batch in its own folder, which a repeated batch overwrites.

    An empty batch is written too: asking first would run the stateful plan twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    if name is not None:
        writer = writer.queryName(name)
    return trigger(writer.option("checkpointLocation", checkpoint), every).start()


def monitor(
    stream: DataFrame,
    checkpoint: str,
    every: str | None = MONITOR_EVERY,
    columns: tuple[str, ...] = MONITOR_COLUMNS,
) -> StreamingQuery:
    """Five rows of each batch on the console; `("*",)` prints every column."""
    writer = (
        stream.select(*columns)
        .writeStream.outputMode("append")
        .format("console")
        .option("truncate", False)
        .option("numRows", 5)
        .option("checkpointLocation", checkpoint)
    )
    return trigger(writer, every).start()


def follow_features(
    spark: SparkSession, path: str, schema, callback: Callable[[DataFrame, int], None],
    checkpoint: str, every: str | None,
) -> StreamingQuery:
    """Run a callback whenever the feature table has new batches."""
    stream = spark.readStream.schema(schema).parquet(f"{path}/batch_id=*")
    writer = stream.writeStream.foreachBatch(callback).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def trainer(
    path: str, root: str, scope: models.Scope, symbols: tuple[str, ...], target: str = "same",
    contest: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Refit on the whole feature table; the batch number is the model version.

    With `contest` the new version is held against the champion and takes its place unless it is worse.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        table = spark.read.parquet(path).drop("batch_id")
        trained = learning.train(table, scope, symbols, target)
        if trained is not None:
            manifest = registry.save(spark, trained, root, batch_id, datetime.now())
            if contest and manifest.champion != batch_id:
                champion = registry.load(spark, root, trained.features, symbols, manifest.champion)
                if learning.not_worse(models.training_rows(table, target), trained, champion):
                    registry.promote(spark, root, batch_id, instead_of=manifest.champion)

    return run


def scorer(
    path: str, root: str, features: list[str], symbols: tuple[str, ...], champion: bool = False
) -> Callable[[DataFrame, int], None]:
    """Score the newest row of each symbol with the newest saved models, or with the champion."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        manifest = registry.read_manifest(spark, root)
        version = manifest.champion if champion else manifest.newest()
        if version is None:
            return
        trained = registry.load(spark, root, features, symbols, version)
        table = spark.read.parquet(path).drop("batch_id")
        scored = learning.predict(table, trained)
        count = len(trained.direction) + len(trained.volatility) + 1
        registry.write_results(scored, root, batch_id, datetime.now(), count)

    return run


def ingest_stream(
    raw: DataFrame, universe: Universe, topic_path: str, reject_path: str, checkpoint: str,
    every: str | None = MONITOR_EVERY,
) -> StreamingQuery:
    """Raw quotes to a topic of valid ones and to dead letters, from one read of the source."""

    def route(batch: DataFrame, batch_id: int) -> None:
        judged = ingest.normalise(batch, universe).persist()
        try:
            values = as_topic_values(ingest.accepted(judged).drop("received_at"))
            values.write.mode("overwrite").json(batch_folder(topic_path, batch_id))
            dead_letters(ingest.rejected(judged)).write.mode("overwrite").partitionBy("date").json(
                batch_folder(reject_path, batch_id)
            )
        finally:
            judged.unpersist()

    writer = raw.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def catch_up(query: StreamingQuery) -> None:
    """Lets a stream with a processing-time trigger read all there is, then stops it.

    Unlike a run of what is available, this also ends with the batch without rows that closes the
    windows the last rows have moved the watermark past, whatever the source.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for the first query to end, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
