"""Historical value at risk and the mean of the losses beyond it.

For `n` ascending returns and level `c` the value at risk is the return at 0-based index
`floor((1 - c) * n)` (the last one if the index runs over), and the conditional value is the
mean up to and including it. Both are reported as absolute values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwell.config import GATES
from tickwell.operators.ordered import Ordered
from tickwell.sources.durable import broadcast_if_small, cut

LEVELS = (0.95, 0.99)
# Cells of the return histogram: relative width 1/CELLS above the scale of 1/SCALE percent.
CELLS, SCALE, PIECES = 1000.0, 1e6, 4096.0


def suffix(level: float) -> str:
    return f"{level * 100:g}".replace(".", "_")


def var_rank(rows: Column, level: float) -> Column:
    """1-based rank of the value at risk among `rows` ascending values."""
    return F.least(F.floor(F.lit(1.0 - level) * rows) + 1, rows)


def var_cvar(
    series: Ordered,
    levels: tuple[float, ...] = LEVELS,
    min_rows: int = GATES.returns,
    digits: int = 4,
) -> DataFrame:
    """One row per symbol with `var_<level>` and `cvar_<level>` for each level.

    No symbol is sorted. A histogram per symbol (log-spaced cells, monotone in the return) gives
    counts and sums; running totals name the cell that holds each rank and everything below it. The rows of
    that cell are cut once more into equal pieces, and the rows of the chosen piece are
    counted by value. Each step is a partial aggregation with bounded groups, and the result
    is exact.
    """
    rows = series.frame.select("symbol", "returns")
    log_cell = F.floor(F.signum("returns") * F.log1p(F.abs("returns") * SCALE) * CELLS)
    celled = rows.withColumn("cell", log_cell.cast("long"))

    sizes = rows.groupBy("symbol").agg(F.count("*").alias("size")).where(
        F.col("size") >= min_rows
    )
    ranks = reduce(
        DataFrame.unionByName,
        [
            sizes.select(
                "symbol",
                F.lit(level).alias("level"),
                var_rank(F.col("size"), level).alias("rank"),
                F.lit(0).cast("long").alias("below"),
                F.lit(0.0).alias("below_sum"),
            )
            for level in levels
        ],
    )

    first = cut(_descend(_totals(celled, ["symbol", "cell"]), ranks, ["symbol"], "cell"))
    in_cell = celled.join(broadcast_if_small(_open_cells(first, ["symbol", "cell"])), ["symbol", "cell"])
    width = F.col("hi") - F.col("lo")
    piece = F.coalesce(F.floor(F.try_divide(F.col("returns") - F.col("lo"), width) * PIECES), F.lit(0))
    pieced = in_cell.select("symbol", "cell", "returns", piece.cast("long").alias("piece"))

    keys = ["symbol", "cell"]
    second = cut(_descend(_totals(pieced, [*keys, "piece"]), first.drop("lo", "hi"), keys, "piece"))
    keys = [*keys, "piece"]
    in_piece = pieced.join(broadcast_if_small(_open_cells(second, keys).drop("lo", "hi")), keys)
    last = _descend(
        _totals(in_piece, [*keys, "returns"], exact=True), second.drop("lo", "hi"), keys, "returns"
    )
    total = F.col("below_sum") + F.col("returns") * (F.col("rank") - F.col("below"))
    found = last.select(
        "symbol",
        "level",
        F.round(F.abs("returns"), digits).alias("var"),
        F.round(F.abs(total / F.col("rank")), digits).alias("cvar"),
    )
    columns = []
    for level in levels:
        here = F.col("level") == level
        columns.append(F.max(F.when(here, F.col("var"))).alias(f"var_{suffix(level)}"))
        columns.append(F.max(F.when(here, F.col("cvar"))).alias(f"cvar_{suffix(level)}"))
    return found.groupBy("symbol").agg(*columns)


def _totals(rows: DataFrame, by: list[str], exact: bool = False) -> DataFrame:
    totals = [F.count("*").alias("rows")]
    if not exact:
        totals += [
            F.sum("returns").alias("sum"),
            F.min("returns").alias("lo"),
            F.max("returns").alias("hi"),
        ]
    return rows.groupBy(*by).agg(*totals)


def _descend(totals: DataFrame, ranks: DataFrame, keys: list[str], cell: str) -> DataFrame:
    """Keep, for every wanted rank, the cell that holds it, with what lies below it."""
    before = (
        Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    )
    amount = F.col("sum") if "sum" in totals.columns else F.col(cell) * F.col("rows")
    running = totals.withColumns(
        {
            "_below": F.coalesce(F.sum("rows").over(before), F.lit(0)),
            "_below_sum": F.coalesce(F.sum(amount).over(before), F.lit(0.0)),
        }
    )
    offset = F.col("rank") - F.col("below")
    held = (offset > F.col("_below")) & (offset <= F.col("_below") + F.col("rows"))
    found = running.join(ranks, keys).where(held)
    keep = [*keys, cell, "level", "rank"]
    keep += [name for name in ("lo", "hi") if name in totals.columns]
    return found.select(
        *keep,
        (F.col("below") + F.col("_below")).alias("below"),
        (F.col("below_sum") + F.col("_below_sum")).alias("below_sum"),
    )


def _open_cells(found: DataFrame, keys: list[str]) -> DataFrame:
    """Two levels may fall into one cell, which must be read once."""
    return found.select(*keys, "lo", "hi").distinct()
