"""Price history on files partitioned by date, read by time range and symbol list."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.config import Universe

# Columns a history row may lack, and what stands in for them.
DEFAULTED = {"percent_change": 0.0, "volatility_score": 0.0, "price_range_pct": 0.0}


def with_defaults(rows: DataFrame) -> DataFrame:
    """Add the columns the source does not have; a null in an existing column stays null."""
    absent = {c: F.lit(v) for c, v in DEFAULTED.items() if c not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def time_range(
    rows: DataFrame,
    now: datetime,
    days: int,
    universe: Universe,
    time: str = "event_time",
) -> DataFrame:
    """Rows of the listed symbols in `[now - days, now]`, both ends included."""
    start = now - timedelta(days=days)
    kind = rows.schema[time].dataType
    ends = [F.lit(str(t)).cast(kind) for t in (start, now)]
    kept = rows.where(F.col(time).between(*ends) & F.col("symbol").isin(*universe.symbols))
    if "date" in rows.columns:
        # Lets the reader skip whole date folders.
        kept = kept.where(F.col("date").between(F.lit(start.date()), F.lit(now.date())))
    return kept


def write_history(rows: DataFrame, path: str, time: str = "event_time", fmt: str = "parquet") -> None:
    """One folder per date. The rows of a date are spread over files by time, so that one
    busy date is not one task."""
    dated = rows.withColumn("date", F.to_date(time))
    dated.repartitionByRange("date", time).write.mode("overwrite").partitionBy("date").format(
        fmt
    ).save(path)


def read_history(
    spark: SparkSession,
    path: str,
    now: datetime,
    days: int,
    universe: Universe,
    fmt: str = "parquet",
    time: str = "event_time",
) -> DataFrame:
    rows = spark.read.format(fmt).load(path)
    if time in rows.columns and dict(rows.dtypes)[time] == "string":
        rows = rows.withColumn(time, F.try_to_timestamp(time))
    return with_defaults(time_range(rows, now, days, universe, time))


def symbols_seen(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows"), F.count_distinct("symbol").alias("symbols")
    )
