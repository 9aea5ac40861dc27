"""Keyed state, its timers and restarts; the journal and the restarts of a failed stream."""

from __future__ import annotations

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_streaming import in_files, stream_of

from tickwell.operators.returns import returns
from tickwell.sources import tables
from tickwell.sources.tables import EVENT_UNIVERSE as U
from tickwell.operators.windows import valid_quotes
from tickwell.streaming import jobs, supervision
from tickwell.streaming.keyed_returns import close_keyed_returns, keyed_return_stream, waiting_rows
from tickwell.streaming.replay import follow, replay


def ticks(spark):
    prices = valid_quotes(tables.price_history(spark, SMALL), U.symbols)
    return prices.withColumn("event_time", F.col("event_time").cast("timestamp"))


def found_returns(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("event_id", F.round("returns", 9)).collect()))


def test_late_rows_over_several_batches_equal_the_batch_answer(spark, tmp_path):
    prices = ticks(spark).withColumn(
        "came", F.unix_seconds("event_time") + F.pmod(F.xxhash64("event_id"), F.lit(3000))
    )
    in_files(prices, str(tmp_path / "in"), 3, "came")
    path, state, marks = (str(tmp_path / n) for n in ("out", "state", "c"))
    stream = stream_of(spark, prices, str(tmp_path / "in"))
    keyed_return_stream(stream, path, state, marks, lateness="1 hour", slot="1 day").awaitTermination()
    assert waiting_rows(spark, marks).count() > 0
    close_keyed_returns(spark, path, state, marks)
    want = returns(prices.drop("came")).frame.select("event_id", F.round("returns", 9))
    assert found_returns(spark, path) == sorted(map(tuple, want.collect()))


def seconds(spark, rows):
    listed = [(i, s, t, p) for i, (s, t, p) in enumerate(rows)]
    frame = spark.createDataFrame(listed, "event_id bigint, symbol string, seconds bigint, current_price double")
    return frame.select("event_id", "symbol", F.timestamp_seconds("seconds").alias("event_time"), "current_price")


def test_restart_late_rows_and_nulls(spark, tmp_path):
    """One query run per part: state, watermark and last price are taken up again from the checkpoint."""
    rows = [
        ("A", 10, 100.0), ("B", 5, None), (None, 7, 1.0),
        # Ninety seconds back is within the delay; the null price has no return and breaks no chain.
        ("A", 1000, 200.0), ("A", 5, 50.0), ("A", 20, None), ("B", 30, 4.0),
        # The watermark has passed second 12 by now.
        ("A", 12, 9.0), ("A", 3000, 100.0), ("B", 2990, 8.0),
    ]
    parts = [0, 0, 0, 1, 1, 1, 1, 2, 2, 2]
    feed = seconds(spark, rows).join(spark.createDataFrame(list(enumerate(parts)), "event_id bigint, part int"), "event_id")
    path, state, marks, fed, journal = (str(tmp_path / n) for n in ("out", "state", "c", "in", "journal"))

    def start(name):
        return keyed_return_stream(follow(feed, fed), path, state, marks, lateness="2 minutes", slot="1 minute", name=name)

    replay(feed.cache(), fed, 3, lambda: supervision.supervise(spark, {"returns": start}, journal))
    close_keyed_returns(spark, path, state, marks)
    assert found_returns(spark, path) == [(0, 100.0), (3, 100.0), (8, -50.0), (9, 100.0)]
    log = supervision.batches(spark, journal)
    assert log.select("run").distinct().count() == 3
    total = supervision.totals(log).first()
    # The reader may skip the row group that has only the row without a symbol.
    assert total["query"] == "returns" and total["input_rows"] in (9, 10) and total["late_rows"] == 1


def test_closing_before_the_first_batch(spark, tmp_path):
    close_keyed_returns(spark, *(str(tmp_path / n) for n in ("out", "state", "c")))


class Fails:
    """A stream whose first starts fail in their batch."""

    def __init__(self, spark, tmp_path, name, failures):
        self.spark, self.base, self.left = spark, tmp_path / name, failures
        self.source = ticks(spark).limit(5)
        self.source.write.parquet(str(self.base / "in"))

    def __call__(self, name):
        def run(batch, batch_id):
            if self.left > 0:
                self.left -= 1
                raise ValueError("planted")
            batch.write.mode("overwrite").parquet(jobs.batch_folder(str(self.base / "out"), batch_id))

        stream = self.spark.readStream.schema(self.source.schema).parquet(str(self.base / "in"))
        writer = stream.writeStream.foreachBatch(run).queryName(name)
        return writer.option("checkpointLocation", str(self.base / "c")).trigger(availableNow=True).start()


def test_a_failed_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    jobs_ = {"shaky": Fails(spark, tmp_path, "shaky", 2), "sound": Fails(spark, tmp_path, "sound", 0)}
    supervision.supervise(spark, jobs_, str(tmp_path / "journal"), restarts=2)
    assert spark.read.parquet(str(tmp_path / "shaky" / "out")).count() == 5
    seen = supervision.events(spark, str(tmp_path / "journal")).groupBy("query", "event").count().collect()
    counts = {(r["query"], r["event"]): r["count"] for r in seen}
    assert counts["shaky", "failed"] == 2 and counts["shaky", "restarted"] == 2 and counts["shaky", "ended"] == 1
    assert counts["sound", "ended"] == 1 and ("sound", "failed") not in counts


def test_a_stream_that_keeps_failing_stops_the_others(spark, tmp_path):
    shaky, steady = Fails(spark, tmp_path, "shaky", 9), Fails(spark, tmp_path, "steady", 0)

    def endless(name):
        stream = spark.readStream.schema(steady.source.schema).parquet(str(steady.base / "in"))
        return jobs.append_batches(stream, str(steady.base / "out"), str(steady.base / "c"), "1 second", name)

    with pytest.raises(Exception, match="planted"):
        supervision.supervise(spark, {"steady": endless, "shaky": shaky}, str(tmp_path / "journal"), restarts=1)
    assert not spark.streams.active
    seen = {(r["query"], r["event"]) for r in supervision.events(spark, str(tmp_path / "journal")).collect()}
    assert {("shaky", "restarted"), ("steady", "stopped")} <= seen


def test_until_ends_processing_time_streams(spark, tmp_path):
    """Triggers by processing time run on; the condition ends them."""
    base = Fails(spark, tmp_path, "in", 0)

    def endless(name):
        stream = spark.readStream.schema(base.source.schema).parquet(str(base.base / "in"))
        return jobs.append_batches(stream, str(base.base / "out"), str(base.base / "c"), "1 second", name)

    done = lambda: (base.base / "out" / "batch_id=0" / "_SUCCESS").exists()
    supervision.supervise(spark, {"steady": endless}, str(tmp_path / "journal"), until=done)
    assert spark.read.parquet(str(base.base / "out")).count() == 5 and not spark.streams.active
