"""Returns on a stream whose waiting rows live in keyed state, released by event-time timers.

Rows wait in a list under (symbol, slot of time), so a busy symbol is as many keys as it has slots.
A timer at the end of the slot hands the list on once the watermark has passed it. Slots leave in
order of time, and each batch links what left to the last price of each symbol, one row per symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickwell.operators.returns import TICK, TIME
from tickwell.shipping import ship
from tickwell.sources.registry import folder_exists
from tickwell.streaming.jobs import LATENESS, batch_folder, trigger
from tickwell.streaming.returns import last_prices, state_of, with_last, write_returns

#: Rows of one symbol and slot wait, and leave, together.
SLOT = "5 minutes"
WAITING = "waiting"
WAITING_ROW = f"{TICK} bigint, {TIME} timestamp, current_price double"
RELEASED = f"symbol string, {WAITING_ROW}"
FIELDS = [TICK, TIME, "current_price"]


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """List state and timers need this store; a stream keeps the store it was first started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class HoldBack(StatefulProcessor):
    """Keeps the rows of a key until the watermark has passed the end of its slot."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState(WAITING, WAITING_ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            prices = frame["current_price"].astype(object).where(frame["current_price"].notna(), None)
            self.waiting.appendList(list(zip(frame[TICK], frame[TIME], prices, strict=True)))
        self.handle.registerTimer(int(key[1]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        rows = pd.DataFrame(list(self.waiting.get()), columns=FIELDS)
        rows.insert(0, "symbol", key[0])
        self.waiting.clear()
        yield rows

    def close(self) -> None:
        pass


def released(prices: DataFrame, lateness: str = LATENESS, slot: str = SLOT) -> DataFrame:
    """The rows of `prices` (a stream), each once, when the watermark has passed its slot.

    Rows that come after the watermark has passed their own time are dropped and counted by the
    operator (`numRowsDroppedByWatermark`). Rows without a time or symbol belong to no slot and are
    left out. To be started under `rocksdb_state`.
    """
    ship(prices.sparkSession)
    placed = prices.where(F.col(TIME).isNotNull() & F.col("symbol").isNotNull()).select("symbol", *FIELDS)
    timed = placed.withWatermark(TIME, lateness)
    keyed = timed.withColumn("slot_end", F.unix_millis(F.window(TIME, slot)["end"]))
    return keyed.groupBy("symbol", "slot_end").transformWithStateInPandas(
        HoldBack(), outputStructType=RELEASED, outputMode="Append", timeMode="EventTime"
    )


def keyed_return_stream(
    prices: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    every: str | None = None,
    lateness: str = LATENESS,
    slot: str = SLOT,
    name: str | None = None,
) -> StreamingQuery:
    """Returns of the rows that leave in each micro-batch, overwritten if the batch is repeated.

    The waiting rows are Spark's own state in `checkpoint`; `state` holds one row per symbol and
    batch. `close_keyed_returns` ends the rows that still wait.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            # Batch numbers have no gaps.
            last = state_of(batch.sparkSession, state, "last", batch_id - 1) if batch_id else None
            joined = with_last(rows, last)
            write_returns(joined, path, batch_id)
            last_prices(joined).write.mode("overwrite").parquet(batch_folder(f"{state}/last", batch_id))
        finally:
            rows.unpersist()

    writer = released(prices, lateness, slot).writeStream.outputMode("append").foreachBatch(run)
    if name is not None:
        writer = writer.queryName(name)
    with rocksdb_state(prices.sparkSession):
        return trigger(writer.option("checkpointLocation", checkpoint), every).start()


def waiting_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows that wait in the state of the last finished batch, read from the checkpoint."""
    stored = spark.read.format("statestore").option("stateVarName", WAITING).load(checkpoint)
    return stored.select(F.col("key.symbol").alias("symbol"), *[F.col(f"list_element.{c}").alias(c) for c in FIELDS])


def close_keyed_returns(spark: SparkSession, path: str, state: str, checkpoint: str) -> None:
    """Returns of the rows that still wait, when no more will come.

    They take the folder of the batch after the last, which a restarted stream overwrites; the state
    itself stays, so a restart goes on as if nothing had been closed.
    """
    if not folder_exists(spark, f"{state}/last"):
        return
    done = max(batch_numbers(spark, f"{state}/last"))
    last = state_of(spark, state, "last", done)
    write_returns(with_last(waiting_rows(spark, checkpoint), last), path, done + 1)


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Batches that have a folder, also those without rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [int(s.getPath().getName().partition("=")[2]) for s in listed if "=" in s.getPath().getName()]
