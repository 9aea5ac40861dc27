"""Returns on a stream: rows wait until the watermark has passed them, then leave in time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.operators.returns import TICK, TIME, returns
from tickwell.operators.windows import arrival_key
from tickwell.sources.registry import folder_exists
from tickwell.streaming.jobs import LATENESS, batch_folder, trigger

PRICE_COLUMNS = (TICK, TIME, "symbol", "current_price")


def last_prices(rows: DataFrame) -> DataFrame:
    newest = arrival_key(TIME, TICK)
    return rows.where(F.col("current_price").isNotNull()).groupBy("symbol").agg(
        F.max_by(TICK, newest).alias(TICK),
        F.max_by(TIME, newest).alias(TIME),
        F.max_by("current_price", newest).alias("current_price"),
    )


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def upto(frontier: int | None) -> Column:
    """Whether the watermark has passed a row; before the first row it has passed none."""
    return F.lit(False) if frontier is None else micros(F.col(TIME)) <= frontier


def state_of(spark: SparkSession, state: str, name: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(batch_folder(f"{state}/{name}", batch_id))


def with_last(ready: DataFrame, last: DataFrame | None) -> DataFrame:
    """The rows that leave, and the price each symbol left off at."""
    rows = ready.withColumn("carried", F.lit(False))
    return rows if last is None else rows.unionByName(last.withColumn("carried", F.lit(True)))


def write_returns(rows: DataFrame, path: str, batch_id: int) -> None:
    """The carried price is the first row of its symbol: it has no return and leaves no row."""
    found = returns(rows).drop_slices().where("not carried").drop("carried")
    found.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def return_stream(
    prices: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    every: str | None = None,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Returns of every micro-batch, overwritten if the batch is repeated.

    The watermark is the newest time so far less `lateness`. Rows behind it leave with their
    returns; newer ones wait in `state`, so a row that is late by less than `lateness` still
    finds its place. Rows that the watermark had passed before they came, and rows without a
    time, are kept in `<state>/late`. `close_returns` ends the last ones that wait.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh, last, passed = batch.select(*PRICE_COLUMNS).persist(), None, None
        too_late = F.col(TIME).isNull()
        waiting = fresh.where(~too_late)
        if batch_id > 0:
            # Batch numbers have no gaps; the mark is one row.
            last = state_of(spark, state, "last", batch_id - 1)
            passed = state_of(spark, state, "mark", batch_id - 1).first()["frontier"]
            too_late = too_late | upto(passed)
            waiting = fresh.where(~too_late).unionByName(state_of(spark, state, "held", batch_id - 1))
        waiting = waiting.persist()
        try:
            newest = F.max(F.col(TIME).cast("timestamp")) - F.expr(f"interval '{lateness}'")
            reached = waiting.agg(F.unix_micros(newest)).first()[0]
            frontier = max((t for t in (passed, reached) if t is not None), default=None)
            rows = with_last(waiting.where(upto(frontier)), last)

            def keep(frame: DataFrame, name: str) -> None:
                frame.write.mode("overwrite").parquet(batch_folder(f"{state}/{name}", batch_id))

            write_returns(rows, path, batch_id)
            keep(last_prices(rows), "last")
            keep(waiting.where(~upto(frontier)), "held")
            keep(fresh.where(too_late), "late")
            keep(spark.range(1).select(F.lit(frontier).cast("long").alias("frontier")), "mark")
        finally:
            waiting.unpersist()
            fresh.unpersist()

    writer = prices.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def close_returns(spark: SparkSession, path: str, state: str) -> None:
    """Returns of the rows that still wait, when no more will come.

    They take the folder of the batch after the last, which a restarted stream overwrites.
    Nothing is written for a stream that never had a batch.
    """
    if not folder_exists(spark, f"{state}/mark"):
        return
    done = spark.read.parquet(f"{state}/mark").agg(F.max("batch_id")).first()[0]
    held, last = state_of(spark, state, "held", done), state_of(spark, state, "last", done)
    write_returns(with_last(held, last), path, done + 1)
