"""Percent returns per symbol and the statistics built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.config import GATES
from tickwell.operators.ordered import Ordered, ordered

TIME, TICK = "event_time", "event_id"


def returns(prices: DataFrame) -> Ordered:
    """Change against the previous non-null price of the symbol, in percent.

    The first row of a symbol and rows after a zero price have no return and are left out;
    so are rows with a null in any other column.
    """
    priced = prices.where(F.col("current_price").isNotNull())
    lagged = ordered(priced, "symbol", (TIME, TICK)).lag("current_price", "previous_price")
    change = (F.try_divide("current_price", "previous_price") - 1) * 100
    complete = lagged.with_columns({"returns": change})
    present = F.lit(True)
    for name in complete.frame.columns:
        present = present & F.col(name).isNotNull()
    return complete.where(present).settle()


def return_statistics(
    rows: DataFrame, min_rows: int = GATES.returns, digits: int = 4
) -> DataFrame:
    return (
        rows.groupBy("symbol")
        .agg(
            F.round(F.avg("returns"), digits).alias("mean_return"),
            F.round(F.stddev_samp("returns"), digits).alias("volatility"),
            F.round(F.min("returns"), digits).alias("min_return"),
            F.round(F.max("returns"), digits).alias("max_return"),
            F.count("*").alias("data_points"),
        )
        .where(F.col("data_points") >= min_rows)
    )


def tracking_error(
    series: Ordered, benchmark: str, min_rows: int = GATES.returns, digits: int = 4
) -> DataFrame:
    """Sample deviation of the return difference to the benchmark, last row against last row.

    Fewer than `min_rows` aligned rows give 0.0; a missing benchmark gives no rows at all.
    """
    placed = series.positions().frame.select(
        "symbol", "returns", (F.col("size") - F.col("position")).alias("back"), "size"
    )
    base = placed.where(F.col("symbol") == benchmark).select(
        "back", F.col("returns").alias("base")
    )
    others = placed.where((F.col("symbol") != benchmark) & (F.col("size") >= min_rows))
    return _difference(others.join(base, "back"), min_rows, digits)


def tracking_error_time_aligned(
    rows: DataFrame,
    benchmark: str,
    bucket: str = "1 hour",
    min_rows: int = GATES.returns,
    digits: int = 4,
) -> DataFrame:
    """The same figure with returns averaged per time bucket and matched on the bucket."""
    averaged = rows.groupBy(F.window(TIME, bucket)["start"].alias("bucket"), "symbol").agg(
        F.avg("returns").alias("returns")
    )
    base = averaged.where(F.col("symbol") == benchmark).select(
        "bucket", F.col("returns").alias("base")
    )
    others = averaged.where(F.col("symbol") != benchmark)
    return _difference(others.join(base, "bucket"), min_rows, digits)


def _difference(pairs: DataFrame, min_rows: int, digits: int) -> DataFrame:
    spread = F.stddev_samp(F.col("returns") - F.col("base"))
    return (
        pairs.groupBy("symbol")
        .agg(F.count("*").alias("aligned"), spread.alias("spread"))
        .select(
            "symbol",
            "aligned",
            F.when(F.col("aligned") < min_rows, 0.0)
            .otherwise(F.round("spread", digits))
            .alias("tracking_error"),
        )
    )
