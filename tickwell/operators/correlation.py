"""Correlation of symbol series on a common time axis, missing times counted as 0."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.shipping import ship
from tickwell.sources.durable import broadcast_if_small, cut

# Above this many symbols the pair expressions would make one very wide aggregate.
EXPRESSION_SYMBOLS = 40
# Symbols of a tile and, roughly, times of a slice: 4 MB for each side of a task's two tiles.
TILE, TIMES = 64, 8192
PRODUCTS = "i int, j int, n bigint, mean_i double, mean_j double, product double"


def time_matrix(
    rows: DataFrame, time: str, value: str, symbols: Sequence[str]
) -> DataFrame:
    """One row per time of a listed symbol, one mean column each, 0 where it has no row."""
    rows = rows.where(F.col("symbol").isin(*symbols))
    if len(symbols) > EXPRESSION_SYMBOLS:
        wide = rows.groupBy(time).pivot("symbol", list(symbols)).agg(F.avg(value))
        return wide.na.fill(0.0, list(symbols))
    # One aggregation by time; a pivot would shuffle by (time, symbol) first.
    means = [F.avg(F.when(F.col("symbol") == s, F.col(value))) for s in symbols]
    return (
        rows.groupBy(time)
        .agg(*[F.coalesce(m, F.lit(0.0)).alias(s) for m, s in zip(means, symbols)])
    )


def pearson(x: str | Column, y: str | Column) -> Column:
    """Correlation that is NULL, not an error, for a constant side."""
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation(
    rows: DataFrame,
    time: str,
    value: str,
    symbols: Sequence[str],
    ordered_pairs: bool = True,
    digits: int = 6,
) -> DataFrame:
    """Long matrix `symbol_a, symbol_b, corr`; `ordered_pairs=False` keeps a < b only.

    The result is the same by expressions, for a list that makes few of them, and by tiles.
    """
    if len(symbols) > EXPRESSION_SYMBOLS:
        return tiled(rows, time, value, symbols, ordered_pairs, digits)
    matrix = time_matrix(rows, time, value, symbols)
    wanted = [
        (i, j)
        for i in range(len(symbols))
        for j in range(len(symbols))
        if ordered_pairs or i < j
    ]
    # Each unordered pair is aggregated once; the mirror entry repeats the value.
    named = {
        (i, j): f"c_{i}_{j}" for i in range(len(symbols)) for j in range(i, len(symbols))
    }
    used = sorted({tuple(sorted(pair)) for pair in wanted})
    totals = matrix.agg(
        *[
            pearson(F.col(f"`{symbols[i]}`"), F.col(f"`{symbols[j]}`")).alias(named[i, j])
            for i, j in used
        ]
    )
    entries = [
        F.struct(
            F.lit(symbols[i]).alias("symbol_a"),
            F.lit(symbols[j]).alias("symbol_b"),
            F.round(F.col(named[tuple(sorted((i, j)))]), digits).alias("corr"),
        )
        for i, j in wanted
    ]
    return totals.select(F.inline(F.array(*entries)))


def tiled(
    rows: DataFrame,
    time: str,
    value: str,
    symbols: Sequence[str],
    ordered_pairs: bool = True,
    digits: int = 6,
    tile: int = TILE,
    times: int = TIMES,
) -> DataFrame:
    """The matrix of `correlation` for many symbols: `tile` symbols by `tile` symbols, slice by slice of time.

    A row holds what one tile of symbols has at one time and goes to each pair its tile is in, so that
    a task meets two tiles over about `times` times. What it gives for a pair of symbols (rows, means and
    centred product) is added up by Spark; times at which neither tile has a row are reckoned as zeros then.
    """
    spark = rows.sparkSession
    ship(spark)
    listed = list(dict.fromkeys(symbols))
    tiles = -(-len(listed) // tile)
    # The list is the caller's: one row for each of its symbols.
    placed = spark.createDataFrame(list(enumerate(listed)), "place int, symbol string")
    means = (
        rows.join(broadcast_if_small(placed), "symbol")
        .groupBy(F.col(time).alias("at"), "place")
        .agg(F.avg(value).alias("mean"))
    )
    cell = F.when(F.col("mean").isNotNull(), F.struct((F.col("place") % tile).alias("column"), "mean"))
    held = cut(means.groupBy("at", F.expr(f"place div {tile}").cast("int").alias("tile")).agg(F.collect_list(cell).alias("cells")))
    count = held.select("at").distinct().count()
    slices = max(1, -(-count // times))
    mine = F.col("tile")
    pair = F.transform(
        F.sequence(F.lit(0), F.lit(tiles - 1)),
        lambda other: F.struct(
            F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b"), (other < mine).alias("second")
        ),
    )
    sent = held.select(
        F.inline(pair), F.pmod(F.xxhash64("at"), F.lit(slices)).alias("slice"), "at",
        F.col("cells.column").alias("column"), F.col("cells.mean").cast("array<double>").alias("mean"),
    )

    def products(key, table):
        return tile_products(key[0].as_py(), key[1].as_py(), table, tile)

    parts = cut(sent.groupBy("a", "b", "slice").applyInArrow(products, PRODUCTS))
    # Means near the real ones, one row for each symbol; with them nothing large is subtracted.
    near = cut(parts.where("i = j").groupBy("i").agg(F.min("mean_i").alias("r")))
    near_i = broadcast_if_small(near.withColumnRenamed("r", "ri"))
    near_j = broadcast_if_small(near.select(F.col("i").alias("j"), F.col("r").alias("rj")))
    n, di, dj = F.col("n"), F.col("mean_i") - F.col("ri"), F.col("mean_j") - F.col("rj")
    added = parts.join(near_i, "i").join(near_j, "j").groupBy("i", "j").agg(
        F.first("ri").alias("ri"), F.first("rj").alias("rj"), (F.lit(count) - F.sum("n")).alias("absent"),
        F.sum(F.col("product") + n * di * dj).alias("xy"), F.sum(n * di).alias("x"), F.sum(n * dj).alias("y"),
    )
    absent, ri, rj = F.col("absent"), F.col("ri"), F.col("rj")
    x, y = F.col("x") - absent * ri, F.col("y") - absent * rj
    moments = cut(added.select("i", "j", (F.col("xy") + absent * ri * rj - x * y / count).alias("xy")))
    own = cut(moments.where("i = j"))
    xx = broadcast_if_small(own.select("i", F.sqrt("xy").alias("sx")))
    yy = broadcast_if_small(own.select("j", F.sqrt("xy").alias("sy")))
    scale = F.col("sx") * F.col("sy")
    corr = F.round(F.try_divide("xy", scale), digits).alias("corr")
    # A symbol without any row is zero throughout, and its pairs are null like those of every constant.
    pairs = F.explode(F.sequence(F.lit(0), F.lit(len(listed) - 1))).alias("j")
    names = placed.select(F.col("place").alias("i"), F.col("symbol").alias("symbol_a"), pairs).join(
        broadcast_if_small(placed.select(F.col("place").alias("j"), F.col("symbol").alias("symbol_b"))), "j"
    )
    found = moments.join(xx, "i").join(yy, "j").select("i", "j", corr)
    both = found.unionByName(found.where("i < j").select(F.col("i").alias("j"), F.col("j").alias("i"), "corr"))
    wanted = names if ordered_pairs else names.where("i < j")
    return wanted.join(both, ["i", "j"], "left").select("symbol_a", "symbol_b", "corr")


def tile_products(a: int, b: int, table: pa.Table, tile: int) -> pa.Table:
    """Rows, means and centred products of each pair of columns of two tiles; absent cells are 0.

    The columns are taken relative to their first value, which leaves exact zeros of a constant.
    """
    at = table["at"].combine_chunks().dictionary_encode()
    line, n = at.indices.to_numpy(), len(at.dictionary)
    second = table["second"].combine_chunks().to_numpy(zero_copy_only=False)
    columns, means = table["column"].combine_chunks(), table["mean"].combine_chunks()
    row = np.repeat(np.arange(len(table)), columns.value_lengths().to_numpy())
    column, mean = columns.flatten().to_numpy(), means.flatten().to_numpy()

    def side(which: bool) -> tuple[np.ndarray, np.ndarray]:
        block, mine = np.zeros((n, tile)), second[row] == which
        block[line[row[mine]], column[mine]] = mean[mine]
        first = block[0].copy()
        block -= first
        shift = block.mean(axis=0)
        block -= shift
        return block, first + shift

    x, mean_x = side(False)
    y, mean_y = (x, mean_x) if a == b else side(True)
    i, j = np.triu_indices(tile) if a == b else (v.ravel() for v in np.indices((tile, tile)))
    return pa.table(
        {
            "i": (a * tile + i).astype(np.int32), "j": (b * tile + j).astype(np.int32),
            "n": np.full(len(i), n, dtype=np.int64), "mean_i": mean_x[i], "mean_j": mean_y[j],
            "product": (x.T @ y)[i, j],
        }
    )
