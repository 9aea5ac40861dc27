"""Order-dependent operators that do not need a whole key in one task.

A quote table has few symbols, so `Window.partitionBy("symbol")` would put a third of the
data into one task. Here a key is cut into contiguous slices of its own order by Spark's
range partitioner (which samples, so hot symbols, hot times and ties are all balanced), the
window runs inside a slice, and what crosses a slice border comes from a table holding one
row per (key, slice). Every input takes this one way, whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tickwell.sources.durable import cut

# Number of slices. Where it is unset, shuffles have the say: at most
# spark.sql.shuffle.partitions slices, small ones joined by adaptive execution.
SLICES_SETTING = "spark.tickwell.slices"
# Rows of one block of a rolling frame.
BLOCK_SETTING = "spark.tickwell.blockRows"
BLOCK_ROWS = 4_000_000


def block_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BLOCK_SETTING, str(BLOCK_ROWS)))


@dataclass(frozen=True)
class Ordered:
    """Rows of `frame` cut into slices; `order` must be unique within a key."""

    frame: DataFrame
    key: str
    order: tuple[str, ...]

    @property
    def part(self) -> list[str]:
        return [self.key, "slice"]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.part).orderBy(*self.order)

    @property
    def by_slice(self) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy("slice")

    def where(self, condition: Column) -> Ordered:
        return replace(self, frame=self.frame.where(condition))

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return replace(self, frame=self.frame.withColumns(columns))

    def settle(self) -> Ordered:
        """Materialise a frame that several jobs read."""
        return replace(self, frame=cut(self.frame))

    def drop_slices(self) -> DataFrame:
        return self.frame.drop("slice")

    def lag(self, column: str, out: str) -> Ordered:
        """Value of `column` on the previous row of the key."""
        marked = self.frame.withColumns(
            {out: F.lag(column).over(self.window), "_at": F.row_number().over(self.window)}
        )
        tails = (
            self.frame.groupBy(*self.part)
            .agg(F.max_by(column, F.struct(*self.order)).alias("_tail"))
            .withColumn("_carry", F.lag("_tail").over(self.by_slice))
            .drop("_tail")
        )
        joined = marked.join(tails, self.part, "left")
        value = F.when(F.col("_at") == 1, F.col("_carry")).otherwise(F.col(out))
        return replace(self, frame=joined.withColumn(out, value).drop("_at", "_carry"))

    def lead(self, columns: dict[str, str]) -> Ordered:
        """Values on the next row of the key, `columns` by output name; NULL on its last row."""
        last = F.row_number().over(Window.partitionBy(*self.part).orderBy(*[F.desc(c) for c in self.order]))
        marked = self.frame.withColumns(
            {out: F.lead(column).over(self.window) for out, column in columns.items()} | {"_left": last}
        )
        first = F.struct(*[F.col(c).alias(f"v{k}") for k, c in enumerate(columns.values())])
        heads = (
            self.frame.groupBy(*self.part)
            .agg(F.min_by(first, F.struct(*self.order)).alias("_head"))
            .withColumn("_carry", F.lead("_head").over(self.by_slice))
            .drop("_head")
        )
        joined = marked.join(heads, self.part, "left")
        values = {
            out: F.when(F.col("_left") == 1, F.col(f"_carry.v{k}")).otherwise(F.col(out))
            for k, out in enumerate(columns)
        }
        return replace(self, frame=joined.withColumns(values).drop("_left", "_carry"))

    def tiles(self, count: int, out: str) -> Ordered:
        """Number, from 1, of the part of a key that a row falls into: `count` parts, the first ones larger."""
        placed = self.positions("_place", "_of")
        small = F.expr(f"_of div {count}")
        larger = F.expr(f"_of % {count}")
        border = (small + 1) * larger
        at = F.col("_place")
        tile = F.when(at <= border, F.ceil(at / (small + 1))).otherwise(larger + F.ceil(F.try_divide(at - border, small)))
        return replace(placed, frame=placed.frame.withColumn(out, tile.cast("int")).drop("_place", "_of"))

    def running_max(self, column: str, out: str) -> Ordered:
        """Largest value of `column` from the first row of the key to this one."""
        inside = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self.by_slice.rowsBetween(Window.unboundedPreceding, -1)
        peaks = (
            self.frame.groupBy(*self.part)
            .agg(F.max(column).alias("_peak"))
            .withColumn("_carry", F.max("_peak").over(before))
            .drop("_peak")
        )
        joined = self.frame.withColumn(out, F.max(column).over(inside)).join(
            peaks, self.part, "left"
        )
        return replace(
            self, frame=joined.withColumn(out, F.greatest(out, "_carry")).drop("_carry")
        )

    def positions(self, out: str = "position", size: str = "size") -> Ordered:
        """1-based position of each row within its key, and the number of rows of the key."""
        before = self.by_slice.rowsBetween(Window.unboundedPreceding, -1)
        counts = (
            self.frame.groupBy(*self.part)
            .agg(F.count("*").alias("_rows"))
            .withColumns(
                {
                    "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
                    size: F.sum("_rows").over(Window.partitionBy(self.key)),
                }
            )
            .drop("_rows")
        )
        joined = self.frame.withColumn("_at", F.row_number().over(self.window)).join(
            counts, self.part, "left"
        )
        return replace(
            self,
            frame=joined.withColumn(out, F.col("_at") + F.col("_before")).drop("_at", "_before"),
        )


def ordered(df: DataFrame, key: str, order: tuple[str, ...]) -> Ordered:
    """Cut `df` into slices of about equal size by (key, order)."""
    wanted = df.sparkSession.conf.get(SLICES_SETTING, None)
    columns = (key, *order) if wanted is None else (int(wanted), key, *order)
    ranged = df.repartitionByRange(*columns).withColumn("slice", F.spark_partition_id())
    # The slice number is a property of this one shuffle, so it is fixed on disk before use.
    return Ordered(cut(ranged), key, order)


def blocks(positioned: DataFrame, key: str, position: str, reach: int, rows: int) -> DataFrame:
    """Copy rows so that a frame reaching `reach` rows back never leaves its block.

    A block holds `rows` consecutive positions (at least `reach`) plus the last `reach`
    positions of the block before, marked `context`.
    """
    size = max(rows, reach)
    home = F.floor((F.col(position) - 1) / size)
    feeds_next = F.col(position) > (home + 1) * size - reach
    targets = F.when(feeds_next, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        positioned.withColumn("block", F.explode(targets))
        .withColumn("context", F.col("block") != home)
    )
