"""Streaming jobs against batch results, on files that arrive one after another."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwell.config import ETF, MODEL_FEATURES
from tickwell.operators import models, windows
from tickwell.operators.returns import returns
from tickwell.operators.windows import valid_quotes, window_features
from tickwell.sources import registry, tables, topics
from tickwell.sources.tables import EVENT_UNIVERSE as U
from tickwell.streaming import jobs
from tickwell.streaming.returns import close_returns, return_stream


def in_files(frame, path, parts, order="event_id"):
    """Time-ordered files, written one by one so that they are read in this order."""
    bounds = [r[0] for r in frame.select(F.ntile(parts).over(Window.orderBy(order)).alias("n"), order)
              .groupBy("n").agg(F.max(order)).orderBy("n").select(f"max({order})").collect()]
    low = -1
    for high in bounds:
        frame.where((F.col(order) > low) & (F.col(order) <= high)).coalesce(1).write.mode("append").parquet(path)
        low = high


def stream_of(spark, frame, path):
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def timed(spark):
    quotes = valid_quotes(tables.quotes(spark, SMALL), U.symbols)
    return quotes.withColumn("processing_time", F.col("event_time").cast("timestamp"))


def test_stream_features_equal_closed_batch_windows(spark, tmp_path):
    quotes = timed(spark)
    in_files(quotes, str(tmp_path / "in"), 3)
    features = jobs.feature_stream(stream_of(spark, quotes, str(tmp_path / "in")))
    jobs.append_batches(features, str(tmp_path / "out"), str(tmp_path / "c"), None).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "out"))
    assert table.select("batch_id").distinct().count() > 1
    last = quotes.agg(F.max("processing_time") - F.expr("interval 10 minutes")).first()[0]
    want = window_features(quotes, "processing_time").where(F.col("window_end") <= F.lit(last))
    columns = ["symbol", "window_start", "data_points", "period_open", "period_close", "volatility_regime"]
    got = sorted(map(tuple, table.select(columns).collect()))
    assert got == sorted(map(tuple, want.select(columns).collect()))


def test_late_rows_are_dropped(spark, tmp_path, price_frame):
    def quotes(rows):
        return price_frame(rows).withColumns(
            {"percent_change": F.lit(0.0), "high": F.col("current_price"), "low": F.col("current_price"),
             "processing_time": F.col("event_time").cast("timestamp")})

    path = str(tmp_path / "in")
    # The watermark that judges late rows is the one known before the batch began, so the
    # late row comes two batches after the row that moves the watermark past it.
    batches = [[("A", 0, 1.0), ("A", 10, 2.0)], [("A", 3000, 3.0)], [("A", 3100, 3.5)],
               [("A", 20, 9.0)], [("A", 9000, 4.0)]]
    for rows in batches:
        quotes(rows).coalesce(1).write.mode("append").parquet(path)
    features = jobs.feature_stream(stream_of(spark, quotes(batches[0]), path))
    jobs.append_batches(features, str(tmp_path / "out"), str(tmp_path / "c"), None).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["data_points"], r["period_close"]) for r in rows] == [(2, 2.0), (2, 3.5)]


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_returns_equal_batch(spark, tmp_path, parts):
    prices = valid_quotes(tables.price_history(spark, SMALL), U.symbols)
    in_files(prices, str(tmp_path / "in"), parts)
    stream = stream_of(spark, prices, str(tmp_path / "in"))
    out = [str(tmp_path / n) for n in ("out", "last", "c")]
    return_stream(stream, *out).awaitTermination()
    close_returns(spark, *out[:2])
    got = spark.read.parquet(out[0]).select("event_id", F.round("returns", 9)).collect()
    want = returns(prices).frame.select("event_id", F.round("returns", 9)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def returns_of(spark, tmp_path, price_frame, batches, lateness):
    path, out = str(tmp_path / "in"), [str(tmp_path / n) for n in ("out", "state", "c")]
    numbered = [(n, row) for n, rows in enumerate(batches) for row in rows]
    whole = price_frame([row for _, row in numbered])
    for n in range(len(batches)):
        ids = [i for i, (at, _) in enumerate(numbered) if at == n]
        whole.where(F.col("event_id").isin(ids)).coalesce(1).write.mode("append").parquet(path)
    return_stream(stream_of(spark, whole, path), *out, lateness=lateness).awaitTermination()
    close_returns(spark, *out[:2])
    found = spark.read.parquet(out[0]).select("event_id", F.round("returns", 2)).collect()
    late = spark.read.parquet(f"{out[1]}/late").count()
    return sorted(map(tuple, found)), late


def test_late_rows_find_their_place_among_the_returns(spark, tmp_path, price_frame):
    batches = [[("A", 1, 100.0), ("A", 5, 110.0)], [("A", 3, 105.0), ("A", 6, 121.0)]]
    found, late = returns_of(spark, tmp_path, price_frame, batches, "10 minutes")
    assert found == [(1, 4.76), (2, 5.0), (3, 10.0)] and late == 0


def test_rows_behind_the_watermark_are_kept_apart(spark, tmp_path, price_frame):
    batches = [[("A", 0, 1.0), ("A", 100, 2.0)], [("A", 200, 3.0)], [("A", 50, 9.0)]]
    found, late = returns_of(spark, tmp_path, price_frame, batches, "1 second")
    assert found == [(1, 100.0), (2, 50.0)] and late == 1


def test_closing_a_stream_that_never_ran(spark, tmp_path):
    close_returns(spark, str(tmp_path / "out"), str(tmp_path / "state"))


def test_scoring_waits_for_the_first_training(spark, tmp_path):
    path, root = str(tmp_path / "features"), str(tmp_path / "registry")
    table = window_features(timed(spark), "processing_time", length="1 day")
    table.write.parquet(jobs.batch_folder(path, 0))
    score = jobs.scorer(path, root, list(MODEL_FEATURES), U.symbols)
    query = jobs.follow_features(spark, path, table.schema, score, str(tmp_path / "c"), None)
    query.awaitTermination()
    assert query.exception() is None and not (tmp_path / "registry").exists()


def test_ingest_stream_accounts_for_every_quote(spark, tmp_path):
    raw = tables.raw_quotes(spark, SMALL).withColumn("received_at", F.col("received_at").cast("timestamp"))
    raw.select("metadata", "body", "received_at").repartition(2).write.json(str(tmp_path / "landing"))
    landed = topics.read_raw_quotes(spark, str(tmp_path / "landing"), stream=True, maxFilesPerTrigger="1")
    out = [str(tmp_path / n) for n in ("topic", "rejects", "c")]
    jobs.ingest_stream(landed, U, *out, every=None).awaitTermination()
    accepted, refused = spark.read.json(out[0]), spark.read.json(out[1])
    assert accepted.count() + refused.count() == raw.count()
    assert accepted.select(F.get_json_object("value", "$.symbol")).distinct().count() == 3
    assert "date" in refused.columns


def test_topic_to_features(spark, tmp_path):
    topic = tables.messages(spark, SMALL).drop("event_id")
    topic.write.parquet(str(tmp_path / "topic"))
    stream = topics.read_topic_stream(spark, "parquet", str(tmp_path / "topic"))
    features = jobs.feature_stream(jobs.quote_stream(stream, U, event_time=True))
    jobs.append_batches(features, str(tmp_path / "out"), str(tmp_path / "c"), None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 100
    assert {r[0] for r in got.select("symbol").distinct().collect()} == set(U.symbols)


def test_arrival_time_is_the_default(spark, tmp_path):
    topic = tables.messages(spark, SMALL).drop("event_id")
    topic.write.parquet(str(tmp_path / "topic"))
    stream = jobs.quote_stream(topics.read_topic_stream(spark, "parquet", str(tmp_path / "topic")), U)
    assert stream.isStreaming
    assert dict(stream.dtypes)["processing_time"] == "timestamp"


def test_monitor_writes_to_the_console(spark, tmp_path):
    quotes = timed(spark)
    in_files(quotes, str(tmp_path / "in"), 1)
    features = jobs.feature_stream(stream_of(spark, quotes, str(tmp_path / "in")))
    query = jobs.monitor(features, str(tmp_path / "c"), None)
    query.awaitTermination()
    assert query.exception() is None
    assert "ConsoleTable" in str(query.lastProgress["sink"]["description"])


def test_train_and_score_follow_the_feature_table(spark, tmp_path):
    path, root = str(tmp_path / "features"), str(tmp_path / "registry")
    table = window_features(timed(spark), "processing_time", length="6 hours")
    table.write.parquet(jobs.batch_folder(path, 0))
    train = jobs.trainer(path, root, models.PerSymbol(U.symbols), U.symbols)
    score = jobs.scorer(path, root, list(MODEL_FEATURES), U.symbols)
    jobs.follow_features(spark, path, table.schema, train, str(tmp_path / "c1"), None).awaitTermination()
    assert registry.latest_version(spark, root) == 0
    jobs.follow_features(spark, path, table.schema, score, str(tmp_path / "c2"), None).awaitTermination()
    results = spark.read.json(f"{root}/results")
    assert {r["symbol"] for r in results.collect()} == set(U.symbols)
    assert {"anomaly", "confidence", "direction", "volatility_forecast", "models_count"} <= set(results.columns)
    assert {r["regime"] for r in results.collect()} <= {"Bear", "Neutral", "Bull"}
    listed = {(r["symbol"], r["kind"]): r["metrics"] for r in registry.entries(spark, root).collect()}
    assert 0 <= listed["view", "direction"]["accuracy"] <= 1 and "r2" in listed["view", "volatility"]
    kinds = {(r["symbol"], r["kind"]) for r in registry.entries(spark, root).collect()}
    assert ("view", "direction") in kinds and ("market", "regime") in kinds
    loaded = registry.load(spark, root, list(MODEL_FEATURES), U.symbols)
    assert set(loaded.regimes.names) == {"Bear", "Neutral", "Bull"}


def test_publish_and_read_back(spark, tmp_path):
    record = spark.createDataFrame(
        [("TEST", 100.5, datetime(2024, 1, 1))], "symbol string, current_price double, at timestamp"
    )
    keyed = topics.as_topic_values(record, F.col("symbol").cast("binary"))
    assert keyed.columns == ["key", "value"]
    topics.publish(record, "json", str(tmp_path / "t"))
    assert topics.has_messages(spark.read.json(str(tmp_path / "t")))
    parsed = spark.read.json(str(tmp_path / "t")).select(F.get_json_object("value", "$.symbol")).first()[0]
    assert parsed == "TEST" and parsed not in ETF.symbols


def test_publish_stream(spark, tmp_path):
    prices = tables.price_history(spark, SMALL)
    in_files(prices, str(tmp_path / "in"), 1)
    stream = stream_of(spark, prices, str(tmp_path / "in"))
    writer = topics.publish_stream(stream, "json", str(tmp_path / "out"), str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == prices.count()
