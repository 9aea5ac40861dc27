"""The registered queries: name to function of (session, table folder)."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.config import MODEL_FEATURES
from tickwell.functions import logs
from tickwell.operators import drift, isolation, models, portfolio, quality, windows
from tickwell.operators.correlation import correlation, time_matrix
from tickwell.operators.returns import (
    TIME,
    return_statistics,
    returns,
    tracking_error,
    tracking_error_time_aligned,
)
from tickwell.operators.tail_risk import var_cvar
from tickwell.plans import ingest, learning
from tickwell.plans.risk import risk_document, risk_metrics
from tickwell.sources import file_topic, history, registry, reports, tables, topics
from tickwell.sources.durable import cut, scratch
from tickwell.sources.tables import EVENT_UNIVERSE as U
from tickwell.streaming import jobs, supervision
from tickwell.streaming.keyed_returns import close_keyed_returns, keyed_return_stream
from tickwell.streaming.replay import follow, replay
from tickwell.streaming.returns import close_returns, return_stream

Query = Callable[[SparkSession, str], DataFrame]
NOW, MIDDLE = datetime(2024, 1, 30), datetime(2024, 1, 16)


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return windows.valid_quotes(tables.price_history(spark, folder), U.symbols)


def valid_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return windows.valid_quotes(tables.quotes(spark, folder), U.symbols)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Engines add doubles in different orders; compare what is common to both."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def features(spark: SparkSession, folder: str, length: str) -> DataFrame:
    return windows.window_features(valid_quotes(spark, folder), length=length)


def ingested(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.normalise(tables.raw_quotes(spark, folder), U)


def checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_messages(tables.messages(spark, folder), U.symbols)


def joined(df: DataFrame, *names: str) -> DataFrame:
    """Arrays as text, which every engine compares alike."""
    return df.withColumns({n: F.array_join(n, "; ") for n in names})


# --- ticks, returns and risk -------------------------------------------------------------


def valid_ticks(spark, folder):
    return ticks(spark, folder)


def returns_query(spark, folder):
    return returns(ticks(spark, folder)).drop_slices().select(
        "event_id", "symbol", TIME, F.round("returns", 6).alias("returns")
    )


def return_statistics_query(spark, folder):
    return return_statistics(returns(ticks(spark, folder)).frame)


def var_cvar_query(spark, folder):
    return var_cvar(returns(ticks(spark, folder)))


def tracking_error_query(spark, folder):
    return tracking_error(returns(ticks(spark, folder)), U.benchmark)


def tracking_error_time_aligned_query(spark, folder):
    return tracking_error_time_aligned(returns(ticks(spark, folder)).frame, U.benchmark)


def return_correlation(spark, folder):
    return correlation(returns(ticks(spark, folder)).frame, TIME, "returns", U.symbols)


def return_correlation_daily(spark, folder):
    rows = returns(ticks(spark, folder)).frame.withColumn("day", F.date_trunc("day", TIME))
    return correlation(rows, "day", "returns", U.symbols)


def momentum_correlation_pairs(spark, folder):
    rows = features(spark, folder, "1 day")
    return correlation(rows, "window_start", "price_momentum", U.symbols, ordered_pairs=False)


def risk_report(spark, folder):
    return risk_metrics(ticks(spark, folder), U)


def risk_document_filed(spark, folder):
    """The full report filed twice under one id, and once under another, read back as figures."""
    document, path = cut(risk_document(ticks(spark, folder), U, NOW)), scratch(spark, "reports")
    stale = document.withColumn("metrics", F.map_filter("metrics", lambda symbol, _: symbol == U.benchmark))
    other = stale.withColumn("document_id", F.lit("benchmark_only"))
    for one in (stale, other, document):
        reports.put_report(one, path)
    found = reports.read_reports(spark, path, document.schema)
    return rounded(reports.report_figures(found))


def history_dated(spark, folder):
    """Price history by date folders, read back for 14 days: counts and sums for each day and symbol."""
    path = scratch(spark, "history")
    history.write_history(tables.price_history(spark, folder), path)
    rows = history.read_history(spark, path, NOW, 14, U)
    return rows.groupBy("date", "symbol").agg(
        F.count("*").alias("ticks"),
        F.round(F.sum("current_price"), 4).alias("total"),
        F.min("event_time").alias("first_time"),
        F.round(F.sum("percent_change"), 4).alias("change"),
    )


def history_range_scan(spark, folder):
    rows = history.time_range(tables.price_history(spark, folder), NOW, 30, U)
    return history.with_defaults(rows)


def symbols_seen(spark, folder):
    return history.symbols_seen(tables.price_history(spark, folder))


# --- window features ----------------------------------------------------------------------


def window_features_5m(spark, folder):
    return rounded(features(spark, folder, "5 minutes"))


def window_features_1d(spark, folder):
    return rounded(features(spark, folder, "1 day"))


def volatility_regime_counts(spark, folder):
    return features(spark, folder, "1 hour").groupBy("volatility_regime", "target_direction").agg(
        F.count("*").alias("windows")
    )


def latest_feature_per_symbol(spark, folder):
    return rounded(windows.latest_features(features(spark, folder, "1 day")))


def next_period_targets(spark, folder):
    return windows.next_period_target(features(spark, folder, "1 day")).select(
        "symbol", "window_start", "target_direction", "next_direction"
    )


def momentum_matrix(spark, folder):
    rows = features(spark, folder, "1 day")
    return rounded(time_matrix(rows, "window_start", "price_momentum", U.symbols))


# --- ingest -------------------------------------------------------------------------------


def ingest_valid(spark, folder):
    kept = ingest.accepted(ingested(spark, folder)).drop("received_at", "debug_error")
    return joined(rounded(kept), "tags")


def ingest_rejected(spark, folder):
    return joined(
        ingest.rejected(ingested(spark, folder)).select(
            "event_id", "symbol", "current_price", "debug_error", "tags", "error_type"
        ),
        "tags",
        "error_type",
    )


def ingest_symbol_source(spark, folder):
    return ingested(spark, folder).groupBy("symbol", "debug_source").agg(
        F.count("*").alias("quotes"), F.count("debug_error").alias("with_error")
    )


# --- message quality ----------------------------------------------------------------------


def parse_rate(spark, folder):
    return quality.parse_rate(quality.parse_quotes(tables.messages(spark, folder)))


def parsed_quotes(spark, folder):
    parsed = quality.parse_quotes(tables.messages(spark, folder))
    return windows.valid_quotes(parsed, U.symbols).drop("kafka_timestamp")


def parsed_sample(spark, folder):
    parsed = quality.parse_quotes(tables.messages(spark, folder), keep=quality.ORDER)
    return quality.parsed_sample(parsed)


def message_fields(spark, folder):
    return quality.message_fields(tables.messages(spark, folder)).drop("text")


def message_checks(spark, folder):
    return joined(checks(spark, folder).drop("timestamp"), "issues")


def message_summary(spark, folder):
    return quality.summarise(checks(spark, folder))


def top_issues(spark, folder):
    return quality.top_issues(checks(spark, folder))


def first_message_verdicts(spark, folder):
    return joined(
        quality.sample_view(checks(spark, folder)).select(
            "partition", "offset", "is_valid", "issues"
        ),
        "issues",
    )


def first_messages(spark, folder):
    sample = quality.first_messages(tables.messages(spark, folder), 10)
    return sample.select("partition", "offset", F.col("value").cast("string").alias("value"))


def first_message(spark, folder):
    return quality.first_message(tables.messages(spark, folder))


def field_commonality(spark, folder):
    return quality.field_commonality(tables.messages(spark, folder))


def schema_consistency(spark, folder):
    return joined(
        quality.schema_consistency(tables.messages(spark, folder)), "common", "issues"
    )


def non_numeric_fields(spark, folder):
    return quality.non_numeric_fields(tables.messages(spark, folder))


def compatibility_tier(spark, folder):
    topic = tables.messages(spark, folder)
    return quality.compatibility(topic, quality.check_messages(topic, U.symbols))


def field_presence(spark, folder):
    return quality.field_presence(tables.messages(spark, folder))


def critical_checks(spark, folder):
    return quality.critical_checks(tables.messages(spark, folder), U.symbols)


def valid_structure(spark, folder):
    return quality.valid_structure(tables.messages(spark, folder))


def field_types(spark, folder):
    return quality.field_types(tables.messages(spark, folder))


def vendor_reply(spark, folder):
    return quality.vendor_reply(tables.raw_quotes(spark, folder))


def topic_size(spark, folder):
    return quality.topic_size(tables.messages(spark, folder))


def text_extract(spark, folder):
    return quality.text_extract(tables.messages(spark, folder))


# --- portfolio ----------------------------------------------------------------------------

# Example settings of the registered queries.
# The rally does not touch every symbol.
SHOCKS = [("crash", "view", -0.3), ("crash", "click", -0.2), ("crash", "purchase", -0.25),
          ("rally", "view", 0.1), ("rally", "purchase", 0.05)]
LIMITS = [("var_95", "view", ">", 50.0), ("max_return", "click", ">", 1000.0),
          ("mean_return", "purchase", "<", 0.0), ("volatility", "view", ">", 100.0)]
WEIGHTS = {"view": 0.5, "click": 0.3, "purchase": 0.2}


def shocks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SHOCKS, "scenario string, symbol string, shock double")


def limits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LIMITS, "metric string, symbol string, op string, threshold double")


def drawdown(spark, folder):
    return portfolio.max_drawdown(ticks(spark, folder))


def portfolio_value(spark, folder):
    return portfolio.portfolio_value(tables.positions(spark, folder), ticks(spark, folder))


def stress_test(spark, folder):
    return portfolio.stress_test(
        tables.positions(spark, folder), ticks(spark, folder), shocks(spark)
    )


def limit_alerts(spark, folder):
    return portfolio.limit_alerts(risk_metrics(ticks(spark, folder), U), limits(spark))


def portfolio_var(spark, folder):
    rows = portfolio.portfolio_returns(returns(ticks(spark, folder)).frame, WEIGHTS, "1 hour")
    return portfolio.portfolio_var(rows)


def rolling_correlation(spark, folder):
    rows = returns(ticks(spark, folder)).frame.withColumn("day", F.date_trunc("day", TIME))
    wide = time_matrix(rows, "day", "returns", U.symbols)
    pairs = [("view", "click"), ("view", "purchase"), ("click", "purchase")]
    return portfolio.rolling_correlation(wide, pairs, "day", 10)


def var_backtest(spark, folder):
    return portfolio.var_backtest(returns(ticks(spark, folder)))


def feature_drift(spark, folder):
    rows = features(spark, folder, "1 day")
    return drift.population_stability(rows, MODEL_FEATURES, F.col("window_start") >= F.lit(MIDDLE))


def temporal_folds(spark, folder):
    return drift.fold_table(features(spark, folder, "1 day"), 4)


# --- models -------------------------------------------------------------------------------


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly features, stored: every model below reads them more than once."""
    return cut(features(spark, folder, "1 hour"))


def scope() -> models.PerSymbol:
    return models.PerSymbol(U.symbols)


def anomaly_counts(spark, folder):
    rows = models.training_rows(feature_table(spark, folder))
    forests = cut(isolation.grow_forests(rows, MODEL_FEATURES))
    scored = cut(isolation.anomaly_scores(rows, forests, MODEL_FEATURES))
    flagged = isolation.flag_anomalies(scored, isolation.cutoffs(scored))
    return isolation.anomaly_counts(flagged)


def direction_accuracy(spark, folder):
    rows = models.training_rows(feature_table(spark, folder))
    fitted = models.fit_direction(rows, MODEL_FEATURES, scope())
    return models.direction_accuracy(rows, fitted)


def direction_accuracy_pooled(spark, folder):
    rows = models.training_rows(feature_table(spark, folder), target="next")
    fitted = models.fit_direction(rows, MODEL_FEATURES, models.Pooled())
    return models.direction_accuracy(rows, fitted)


def feature_importance(spark, folder):
    rows = models.training_rows(feature_table(spark, folder))
    fitted = models.fit_direction(rows, MODEL_FEATURES, scope())
    return models.feature_importance(rows, fitted, MODEL_FEATURES)


def volatility_r2(spark, folder):
    rows = models.training_rows(feature_table(spark, folder))
    return models.volatility_r2(rows, models.fit_volatility(rows, MODEL_FEATURES, scope()))


def regime_counts(spark, folder):
    rows = feature_table(spark, folder)
    return models.regime_counts(rows, models.fit_regimes(rows, U.symbols))


def current_regime(spark, folder):
    rows = feature_table(spark, folder)
    return models.current_regime(rows, models.fit_regimes(rows, U.symbols))


def predictions(spark, folder):
    rows = feature_table(spark, folder)
    return learning.predict(rows, learning.train(rows, scope(), U.symbols))


def temporal_cross_validation(spark, folder):
    return learning.cross_validate(feature_table(spark, folder), scope())


def accuracy_drift(spark, folder):
    rows = models.training_rows(feature_table(spark, folder))
    fitted = models.fit_direction(rows, MODEL_FEATURES, scope())
    scored = models.apply_models(rows, fitted)
    trained = models.direction_accuracy(rows, fitted)
    return drift.accuracy_by_window(scored, trained, "7 days")


# --- streams ------------------------------------------------------------------------------


def finished(query: StreamingQuery) -> None:
    query.awaitTermination()


def stream_window_features(spark, folder):
    quotes = windows.valid_quotes(
        tables.as_quotes(tables.event_stream(spark, folder)), U.symbols
    ).withColumnRenamed("event_time", "processing_time")
    path, marks = scratch(spark, "features"), scratch(spark, "marks")
    finished(jobs.append_batches(jobs.feature_stream(quotes), path, marks, every=None))
    table = spark.read.parquet(path).drop("batch_id")
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return rounded(table.withColumns(bounds))


def stream_returns(spark, folder):
    events = tables.event_stream(spark, folder)
    prices = windows.valid_quotes(tables.as_prices(events), U.symbols)
    path, state = scratch(spark, "returns"), scratch(spark, "last")
    finished(return_stream(prices, path, state, scratch(spark, "marks")))
    close_returns(spark, path, state)
    return spark.read.parquet(path).select(
        "event_id",
        "symbol",
        F.col(TIME).cast("timestamp_ntz").alias(TIME),
        F.round("returns", 6).alias("returns"),
    )


def stream_ingest(spark, folder):
    raw = tables.as_raw_quotes(tables.as_quotes(tables.event_stream(spark, folder)))
    topic, rejects = scratch(spark, "topic"), scratch(spark, "rejects")
    finished(jobs.ingest_stream(raw, U, topic, rejects, scratch(spark, "marks"), every=None))
    accepted = spark.read.json(topic).select(
        F.get_json_object("value", "$.symbol").alias("symbol"), F.lit("valid").alias("route")
    )
    refused = spark.read.schema("symbol string").json(rejects).select(
        "symbol", F.lit("rejected").alias("route")
    )
    return accepted.unionByName(refused).groupBy("symbol", "route").agg(
        F.count("*").alias("quotes")
    )


PARTS, DELAY, SLOT = 3, "2 hours", "6 hours"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """The ticks as a feed in parts; stored, since each part is cut from it."""
    quotes = windows.valid_quotes(tables.quotes(spark, folder), U.symbols)
    fed = tables.arrivals(quotes, PARTS)
    return cut(fed.withColumn("event_time", F.col("event_time").cast("timestamp")))


def stream_keyed_returns(spark, folder):
    """Late ticks, three batches, the stream started anew for each."""
    feed, fed = arriving(spark, folder), scratch(spark, "feed")
    path, state, marks = (scratch(spark, n) for n in ("returns", "last", "marks"))
    replay(
        feed, fed, PARTS,
        lambda: finished(keyed_return_stream(follow(feed, fed), path, state, marks, lateness=DELAY, slot=SLOT)),
    )
    close_keyed_returns(spark, path, state, marks)
    return spark.read.parquet(path).select(
        "event_id",
        "symbol",
        F.col(TIME).cast("timestamp_ntz").alias(TIME),
        F.round("returns", 6).alias("returns"),
    )


def topic_features(spark, folder):
    """Raw quotes to a topic, the topic to features: two publications, the stream resumed by its offsets."""
    quotes = ingest.accepted(ingested(spark, folder)).withColumn("at", F.col("received_at").cast("timestamp"))
    stored = cut(topics.as_topic_rows(quotes, F.col("symbol"), "at", ("event_id",)))
    topic, table, marks = (scratch(spark, n) for n in ("topic", "features", "marks"))
    file_topic.register(spark)
    for part in (F.col("timestamp") < F.lit(MIDDLE), F.col("timestamp") >= F.lit(MIDDLE)):
        file_topic.publish_log(stored.where(part), topic, "quotes", ("timestamp", "event_id"), 3)
        stream = topics.read_topic_stream(spark, file_topic.FORMAT, topic, startingOffsets="earliest")
        features = jobs.feature_stream(jobs.quote_stream(stream, U, event_time=True))
        jobs.catch_up(jobs.append_batches(features, table, marks, every="1 second"))
    found = spark.read.parquet(table).drop("batch_id")
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return rounded(found.withColumns(bounds))


def topic_offsets(spark, folder):
    """A topic of all messages read back between offsets: from 100 on, to before the last 50 of each partition."""
    file_topic.register(spark)
    topic = scratch(spark, "topic")
    file_topic.append_log(tables.messages(spark, folder), topic, 1000)
    ends = file_topic.Log(topic).end()
    wanted = {"startingOffsets": json.dumps({p: 100 for p in ends}),
              "endingOffsets": json.dumps({p: o - 50 for p, o in ends.items()})}
    read = topics.read_topic(spark, file_topic.FORMAT, topic, **wanted)
    return read.groupBy("partition").agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.sum(F.length("value")).alias("bytes"), F.count_distinct("key").alias("keys"),
    )


def stream_journal(spark, folder):
    """What the journal says of two streams over the same late feed.

    An aggregation counts late rows after it has combined them, so only the other has that figure.
    """
    feed, fed, journal = arriving(spark, folder), scratch(spark, "feed"), scratch(spark, "journal")
    path, state, marks, table, other = (scratch(spark, n) for n in ("returns", "last", "marks", "features", "marks"))

    def returned(name: str) -> StreamingQuery:
        return keyed_return_stream(follow(feed, fed), path, state, marks, lateness=DELAY, slot=SLOT, name=name)

    def featured(name: str) -> StreamingQuery:
        quotes = follow(feed, fed).withColumnRenamed("event_time", "processing_time")
        return jobs.append_batches(jobs.feature_stream(quotes), table, other, every=None, name=name)

    streams = {"returns": returned, "features": featured}
    replay(feed, fed, PARTS, lambda: supervision.supervise(spark, streams, journal))
    found = supervision.totals(supervision.batches(spark, journal))
    return found.select(
        "query",
        "input_rows",
        F.when(F.col("query") == "returns", F.col("late_rows")).alias("late_rows"),
        F.col("watermark").cast("timestamp_ntz").alias("watermark"),
    )


def model_versions(spark, folder):
    """The trainer after each of two feature batches, and what its registry lists then.

    `trained_rows` is known for the volatility models alone.
    """
    table = feature_table(spark, folder)
    path, root, marks = (scratch(spark, n) for n in ("features", "registry", "marks"))
    train = jobs.trainer(path, root, scope(), U.symbols, contest=True)
    for number, part in enumerate((F.col("window_start") < F.lit(MIDDLE), F.col("window_start") >= F.lit(MIDDLE))):
        table.where(part).write.parquet(jobs.batch_folder(path, number))
        finished(jobs.follow_features(spark, path, table.schema, train, marks, None))
    listed = registry.entries(spark, root).join(registry.versions(spark, root).drop("trained_at"), "version")
    return listed.select(
        "version", "parent", "symbol", "kind", "rows",
        F.col("since").cast("timestamp_ntz").alias("since"), F.col("until").cast("timestamp_ntz").alias("until"),
        F.when(F.col("kind") == "volatility", F.col("metrics")["rows"]).cast("bigint").alias("trained_rows"),
    )


# --- logs ---------------------------------------------------------------------------------


def log_pattern_counts(spark, folder):
    return logs.pattern_counts(tables.log_lines(spark, folder))


def log_line_classes(spark, folder):
    return logs.class_counts(tables.log_lines(spark, folder))


def log_last_errors(spark, folder):
    return logs.last_matching(tables.log_lines(spark, folder), "ERROR", 3, ("event_id",))


QUERIES: dict[str, Query] = {
    "valid_ticks": valid_ticks,
    "returns": returns_query,
    "return_statistics": return_statistics_query,
    "var_cvar": var_cvar_query,
    "tracking_error": tracking_error_query,
    "tracking_error_time_aligned": tracking_error_time_aligned_query,
    "return_correlation": return_correlation,
    "return_correlation_daily": return_correlation_daily,
    "momentum_correlation_pairs": momentum_correlation_pairs,
    "risk_report": risk_report,
    "risk_document_filed": risk_document_filed,
    "history_dated": history_dated,
    "history_range_scan": history_range_scan,
    "symbols_seen": symbols_seen,
    "window_features_5m": window_features_5m,
    "window_features_1d": window_features_1d,
    "volatility_regime_counts": volatility_regime_counts,
    "latest_feature_per_symbol": latest_feature_per_symbol,
    "next_period_targets": next_period_targets,
    "momentum_matrix": momentum_matrix,
    "ingest_valid": ingest_valid,
    "ingest_rejected": ingest_rejected,
    "ingest_symbol_source": ingest_symbol_source,
    "parse_rate": parse_rate,
    "parsed_quotes": parsed_quotes,
    "parsed_sample": parsed_sample,
    "message_fields": message_fields,
    "message_checks": message_checks,
    "message_summary": message_summary,
    "top_issues": top_issues,
    "first_message_verdicts": first_message_verdicts,
    "first_messages": first_messages,
    "first_message": first_message,
    "field_commonality": field_commonality,
    "schema_consistency": schema_consistency,
    "non_numeric_fields": non_numeric_fields,
    "compatibility_tier": compatibility_tier,
    "field_presence": field_presence,
    "critical_checks": critical_checks,
    "valid_structure": valid_structure,
    "field_types": field_types,
    "vendor_reply": vendor_reply,
    "topic_size": topic_size,
    "text_extract": text_extract,
    "drawdown": drawdown,
    "portfolio_value": portfolio_value,
    "stress_test": stress_test,
    "limit_alerts": limit_alerts,
    "portfolio_var": portfolio_var,
    "rolling_correlation": rolling_correlation,
    "var_backtest": var_backtest,
    "feature_drift": feature_drift,
    "temporal_folds": temporal_folds,
    "anomaly_counts": anomaly_counts,
    "direction_accuracy": direction_accuracy,
    "direction_accuracy_pooled": direction_accuracy_pooled,
    "feature_importance": feature_importance,
    "volatility_r2": volatility_r2,
    "regime_counts": regime_counts,
    "current_regime": current_regime,
    "predictions": predictions,
    "temporal_cross_validation": temporal_cross_validation,
    "accuracy_drift": accuracy_drift,
    "stream_window_features": stream_window_features,
    "stream_returns": stream_returns,
    "stream_ingest": stream_ingest,
    "stream_keyed_returns": stream_keyed_returns,
    "stream_journal": stream_journal,
    "topic_features": topic_features,
    "topic_offsets": topic_offsets,
    "model_versions": model_versions,
    "log_pattern_counts": log_pattern_counts,
    "log_line_classes": log_line_classes,
    "log_last_errors": log_last_errors,
}
