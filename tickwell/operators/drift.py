"""Feature drift, accuracy over time and time-ordered validation folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwell.operators.ordered import ordered

BINS, FLOOR_SHARE = 10, 1e-4


def population_stability(
    rows: DataFrame, features: Sequence[str], recent: Column, digits: int = 6
) -> DataFrame:
    """Stability index per feature between the rows before and the rows marked `recent`.

    Equal-width bins over the older range; newer values outside fall into the end bins.
    """
    values = [F.col(f).cast("double").alias(f) for f in features]
    long = (
        rows.select(recent.alias("recent"), *values)
        .unpivot("recent", list(features), "feature", "value")
        .where(F.col("value").isNotNull())
    )
    # One row per feature, a list fixed when the job is written.
    ranges = long.where(~F.col("recent")).groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    place = F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")) * BINS
    bin_ = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(F.coalesce(place, F.lit(0.0)))))
    counts = (
        long.join(F.broadcast(ranges), "feature")
        .groupBy("feature", bin_.alias("bin"))
        .agg(
            F.count_if(~F.col("recent")).alias("older"),
            F.count_if("recent").alias("newer"),
        )
    )
    whole = Window.partitionBy("feature")
    older = F.greatest(F.try_divide("older", F.sum("older").over(whole)), F.lit(FLOOR_SHARE))
    newer = F.greatest(
        F.coalesce(F.try_divide("newer", F.sum("newer").over(whole)), F.lit(0.0)),
        F.lit(FLOOR_SHARE),
    )
    shares = counts.select("feature", older.alias("p"), newer.alias("q"))
    term = (F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))
    return shares.groupBy("feature").agg(F.round(F.sum(term), digits).alias("stability_index"))


def accuracy_by_window(
    scored: DataFrame, trained: DataFrame, length: str, tolerance: float = 0.1
) -> DataFrame:
    """Accuracy per longer window next to training accuracy; `drifted` when it falls behind.

    `trained(symbol, accuracy)` has one row per symbol.
    """
    hit = (F.col("prediction") == F.col("direction_label")).cast("double")
    recent = scored.groupBy("symbol", F.window("window_start", length)["start"].alias("since")).agg(
        F.count("*").alias("rows"), F.avg(hit).alias("window_accuracy")
    )
    behind = F.col("window_accuracy") < F.col("accuracy") - tolerance
    return recent.join(trained.select("symbol", "accuracy"), "symbol").withColumn("drifted", behind)


def with_folds(rows: DataFrame, folds: int) -> DataFrame:
    """Equal time-ordered folds per symbol; one row per symbol and window."""
    return ordered(rows, "symbol", ("window_start",)).tiles(folds, "fold").drop_slices()


def fold_table(rows: DataFrame, folds: int) -> DataFrame:
    """For every test fold after the first, the size of it and of all folds before it."""
    sizes = (
        with_folds(rows, folds)
        .groupBy("symbol", "fold")
        .agg(
            F.count("*").alias("test_rows"),
            F.min("window_start").alias("test_start"),
            F.max("window_start").alias("test_end"),
        )
    )
    before = (
        Window.partitionBy("symbol").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.withColumn("train_rows", F.sum("test_rows").over(before)).where("fold > 1")
