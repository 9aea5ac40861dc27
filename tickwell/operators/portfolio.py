"""Positions, limits, drawdown, rolling figures and backtests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwell.operators.ordered import Ordered, blocks, ordered, block_rows
from tickwell.operators.returns import TICK, TIME
from tickwell.operators.tail_risk import var_cvar, var_rank
from tickwell.operators.windows import arrival_key
from tickwell.sources.durable import broadcast_if_small, cut


def drawdown(prices: DataFrame) -> Ordered:
    """Loss against the highest price so far, per row."""
    peaks = ordered(prices, "symbol", (TIME, TICK)).running_max("current_price", "peak")
    return peaks.with_columns({"drawdown": F.try_divide("current_price", "peak") - 1})


def max_drawdown(prices: DataFrame, digits: int = 6) -> DataFrame:
    return drawdown(prices).frame.groupBy("symbol").agg(
        F.round(F.min("drawdown"), digits).alias("max_drawdown"), F.count("*").alias("ticks")
    )


def latest_prices(prices: DataFrame) -> DataFrame:
    """Newest price per symbol, stored: its users count it before they broadcast it."""
    newest = F.max_by("current_price", arrival_key(TIME, TICK)).alias("price")
    return cut(prices.groupBy("symbol").agg(newest))


def valued_positions(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Every holding with its value, null where the symbol has no price."""
    latest = broadcast_if_small(latest_prices(prices))
    return positions.join(latest, "symbol", "left").select(
        "account", "symbol", (F.col("quantity") * F.col("price")).alias("value")
    )


def total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def portfolio_value(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Value per account; holdings without a price are counted, not dropped."""
    return valued_positions(positions, prices).groupBy("account").agg(
        F.round(total(F.col("value")), 4).alias("value"),
        F.count("*").alias("holdings"),
        F.count_if(F.col("value").isNull()).alias("unpriced"),
    )


def stress_test(positions: DataFrame, prices: DataFrame, shocks: DataFrame) -> DataFrame:
    """Value per account and scenario; a symbol that `shocks(scenario, symbol, shock)` leaves out
    keeps its value, one without a price is counted. Shocks that are listed twice add up;
    rows without a scenario are left out.

    Positions, added up before, are repeated once per scenario name; the shocks themselves are joined.
    """
    names = shocks.agg(F.array_sort(F.collect_set("scenario")).alias("names"))
    listed = shocks.groupBy("scenario", "symbol").agg(F.sum("shock").alias("shock"))
    valued = valued_positions(positions, prices).withColumn("names", names.scalar())
    repeated = valued.select("account", "symbol", "value", F.explode("names").alias("scenario"))
    shocked = repeated.join(listed, ["scenario", "symbol"], "left")
    shock = F.coalesce(F.col("shock"), F.lit(0.0))
    stressed = total(F.col("value") * (1 + shock))
    return shocked.groupBy("scenario", "account").agg(
        F.round(total(F.col("value")), 4).alias("value"),
        F.round(stressed, 4).alias("stressed_value"),
        F.round(stressed - total(F.col("value")), 4).alias("loss"),
        F.count_if(F.col("value").isNull()).alias("unpriced"),
    )


def limit_alerts(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Metrics outside their limit; `limits(metric, symbol, op, threshold)`, op '>' or '<'."""
    names = [c for c in metrics.columns if c not in ("symbol", "data_points")]
    long = metrics.unpivot("symbol", names, "metric", "value")
    broken = ((F.col("op") == ">") & (F.col("value") > F.col("threshold"))) | (
        (F.col("op") == "<") & (F.col("value") < F.col("threshold"))
    )
    return long.join(broadcast_if_small(limits), ["metric", "symbol"]).where(broken)


def portfolio_returns(series: DataFrame, weights: dict[str, float], bucket: str) -> DataFrame:
    """Weighted return per time bucket, an absent symbol counting as 0."""
    mean = series.where(F.col("symbol").isin(*weights)).groupBy(
        F.window(TIME, bucket)["start"].alias(TIME), "symbol"
    ).agg(F.avg("returns").alias("returns"))
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return mean.groupBy(TIME).agg(
        F.sum(F.col("returns") * table[F.col("symbol")]).alias("returns")
    )


def portfolio_var(rows: DataFrame) -> DataFrame:
    """Tail figures of portfolio returns, one row per time bucket, as one series."""
    series = rows.select(F.lit("portfolio").alias("symbol"), TIME, "returns")
    return var_cvar(ordered(series, "symbol", (TIME,)))


def rolling_correlation(
    buckets: DataFrame, pairs: list[tuple[str, str]], time: str, k: int, digits: int = 6
) -> DataFrame:
    """Correlation over the trailing `k` time buckets for each pair.

    `buckets` is wide (one row per time bucket, one column per symbol), so its size follows
    the time span. The buckets are numbered and cut into blocks before the frame runs.
    """
    placed = ordered(buckets.withColumn("series", F.lit("all")), "series", (time,)).positions()
    cut_rows = placed.drop_slices()
    spread = blocks(cut_rows, "series", "position", k - 1, block_rows(buckets))
    frame = Window.partitionBy("block").orderBy("position").rowsBetween(-(k - 1), 0)
    entries = []
    for a, b in pairs:
        x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
        value = F.try_divide(
            F.covar_samp(x, y).over(frame),
            F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame),
        )
        entries.append((a, b, value))
    rolled = spread.withColumns({f"_c{i}": value for i, (_, _, value) in enumerate(entries)})
    rows = [
        F.struct(
            F.lit(a).alias("symbol_a"),
            F.lit(b).alias("symbol_b"),
            F.round(f"_c{i}", digits).alias("corr"),
        )
        for i, (a, b, _) in enumerate(entries)
    ]
    return rolled.where(~F.col("context") & (F.col("position") >= k)).select(
        time, F.inline(F.array(*rows))
    )


def var_backtest(
    series: Ordered, level: float = 0.95, k: int = 100, digits: int = 6
) -> DataFrame:
    """Share of returns below the rolling value at risk of the `k` returns before them."""
    placed = series.positions().drop_slices()
    spread = blocks(placed, "symbol", "position", k, block_rows(placed))
    frame = Window.partitionBy("symbol", "block").orderBy("position").rowsBetween(-k, -1)
    history = F.sort_array(F.collect_list("returns").over(frame))
    floor = F.element_at(F.col("history"), var_rank(F.lit(k), level).cast("int"))
    judged = (
        spread.withColumn("history", history)
        .where(~F.col("context") & (F.size("history") == k))
        .select("symbol", (F.col("returns") < floor).alias("breach"))
    )
    return judged.groupBy("symbol").agg(
        F.count("*").alias("tested"),
        F.count_if("breach").alias("breaches"),
        F.round(F.avg(F.col("breach").cast("double")), digits).alias("breach_rate"),
        F.round(F.lit(1.0 - level), digits).alias("expected_rate"),
    )
