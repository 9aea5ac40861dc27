"""Watching several streams: what each batch did, as a table, and restart or stop on failure."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

JOURNAL = (
    "query string, run string, batch_id bigint, input_rows bigint, late_rows bigint, "
    "state_rows bigint, watermark timestamp, took_ms bigint, at timestamp"
)
EVENTS = "query string, run string, event string, detail string, at timestamp"
STARTED, FAILED, ENDED, RESTARTED, STOPPED = "started", "failed", "ended", "restarted", "stopped"
#: Fixed value: seconds between two looks at the queries.
PAUSE = 0.2


def moment(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text.replace("Z", "+00:00"))


class BatchJournal(StreamingQueryListener):
    """Remembers the progress of every batch and writes it out in parts.

    Progress comes on Spark's listener thread; there it is only noted down. `flush` writes what has
    gathered, in a file of its own, so nothing is rewritten and nothing grows in memory for long.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.lock, self.rows, self.events = threading.Lock(), [], []
        self.names: dict[str, str] = {}

    def note(self, name: str, run: str, event: str, detail: str | None = None) -> None:
        with self.lock:
            self.events.append((name, run, event, detail, datetime.now(UTC)))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.names[str(event.runId)] = event.name or str(event.id)
        self.note(event.name or str(event.id), str(event.runId), STARTED)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        states = p.stateOperators
        row = (
            p.name or str(p.id),
            str(p.runId),
            p.batchId,
            p.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in states),
            sum(s.numRowsTotal for s in states),
            moment(p.eventTime.get("watermark")),
            p.durationMs.get("triggerExecution"),
            moment(p.timestamp),
        )
        with self.lock:
            self.rows.append(row)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        run = str(event.runId)
        self.note(self.names.pop(run, str(event.id)), run, FAILED if event.exception else ENDED, event.exception)

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
            events, self.events = self.events, []
        for name, schema, held in (("batches", JOURNAL, rows), ("events", EVENTS, events)):
            if held:
                self.spark.createDataFrame(held, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")


@dataclass
class Watched:
    """A stream that can be started again: `start` gets the name and uses one checkpoint throughout."""

    start: Callable[[str], StreamingQuery]
    restarts: int = 0
    query: StreamingQuery | None = field(default=None, repr=False)

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive


def supervise(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[str], StreamingQuery]],
    path: str,
    restarts: int = 3,
    every: float = 5.0,
    until: Callable[[], bool] | None = None,
) -> BatchJournal:
    """Runs the streams until all have ended, `until` says so, or one has failed for good.

    A failed stream is started again, `restarts` times at most, and goes on from its checkpoint. One
    that fails once more stops the others, since they feed each other; its error is raised when all
    have stopped. The journal at `path` is written every `every` seconds and at the end.
    """
    journal = BatchJournal(spark, path)
    spark.streams.addListener(journal)
    watched = {name: Watched(start) for name, start in jobs.items()}
    given_up, flushed = None, time.monotonic()
    try:
        for name, job in watched.items():
            job.query = job.start(name)
        while True:
            alive = any(job.running for job in watched.values())
            given_up = restart_failed(watched, journal, restarts)
            # What failed after the first look is started again on the next round.
            over = not alive and not any(job.running for job in watched.values())
            if given_up is not None or over or (until is not None and until()):
                break
            if time.monotonic() - flushed >= every:
                journal.flush()
                flushed = time.monotonic()
            time.sleep(PAUSE)
    finally:
        for name, job in watched.items():
            if job.running:
                job.query.stop()
                journal.note(name, str(job.query.runId), STOPPED)
        drain(spark, journal, [job.query for job in watched.values() if job.query is not None])
        spark.streams.removeListener(journal)
        journal.flush()
    if given_up is not None:
        raise given_up
    return journal


def restart_failed(watched: Mapping[str, Watched], journal: BatchJournal, most: int) -> Exception | None:
    """Starts again what has failed; the error of a stream that has failed too often."""
    for name, job in watched.items():
        if job.query is None or job.query.isActive:
            continue
        error = job.query.exception()
        if error is None:
            continue
        if job.restarts >= most:
            return error
        job.restarts += 1
        journal.note(name, str(job.query.runId), RESTARTED, f"{job.restarts} of {most}")
        job.query = job.start(name)
    return None


def drain(spark: SparkSession, journal: BatchJournal, queries: list[StreamingQuery], seconds: float = 30.0) -> None:
    """Waits until the listener has heard the end of every query; progress comes before the end."""
    limit, wanted = time.monotonic() + seconds, {str(q.runId) for q in queries}
    while time.monotonic() < limit and wanted & set(journal.names):
        time.sleep(PAUSE)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query and batch; of a batch that was run again, the last run.

    Runs that a restart cut short leave no row. Progress that only says that nothing came is left out.
    """
    rows = spark.read.schema(JOURNAL).parquet(f"{path}/batches")
    rest = [c for c in rows.columns if c not in ("query", "batch_id")]
    done = rows.where("took_ms is not null")
    latest = done.groupBy("query", "batch_id").agg(F.max_by(F.struct(*rest), "at").alias("row"))
    return latest.select("query", "batch_id", "row.*")


def events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{path}/events")


def totals(journal: DataFrame) -> DataFrame:
    """For each query: batches, rows read, rows that came too late, rows that wait, last watermark."""
    newest = F.col("batch_id")
    return journal.groupBy("query").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", newest).alias("state_rows"),
        F.max("watermark").alias("watermark"),
    )
