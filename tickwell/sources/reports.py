"""Risk report documents and their sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What a report is filed under.
FILED = ("month", "document_id")


def report_rows(
    statistics: DataFrame, tails: DataFrame, tracking: DataFrame
) -> DataFrame:
    """One row per symbol with all figures; no tracking error for the benchmark itself."""
    error = tracking.select("symbol", "tracking_error")
    return statistics.join(tails, "symbol", "left").join(error, "symbol", "left")


def report_document(
    metrics: DataFrame, correlation: DataFrame, now: datetime, days: int
) -> DataFrame:
    """The nested report: metrics per symbol and the correlation map of maps.

    Both inputs are results with one row per symbol (pair), collected into the one document
    the report consists of.
    """
    nested = metrics.select(
        F.struct(
            F.struct("var_95", "var_99", "cvar_95", "cvar_99").alias("var"),
            "tracking_error",
            F.struct(
                "mean_return", "volatility", "min_return", "max_return", "data_points"
            ).alias("statistics"),
        ).alias("figures"),
        "symbol",
    ).agg(F.map_from_entries(F.collect_list(F.struct("symbol", "figures"))).alias("metrics"))
    per_symbol = correlation.groupBy("symbol_a").agg(
        F.map_from_entries(F.collect_list(F.struct("symbol_b", "corr"))).alias("row")
    )
    matrix = per_symbol.agg(
        F.map_from_entries(F.collect_list(F.struct("symbol_a", "row"))).alias("matrix")
    )
    return nested.select(
        F.lit(now.isoformat()).alias("calculation_time"),
        F.lit(days).alias("data_period_days"),
        "metrics",
        matrix.scalar().alias("correlation_matrix"),
        F.lit(f"risk_metrics_{now:%Y%m%d_%H%M%S}").alias("document_id"),
        F.lit(f"{now:%Y-%m}").alias("month"),
    )


def write_report(document: DataFrame, path: str, fmt: str = "json", **options: str) -> None:
    """One folder per month; a document store connector is a format and its options."""
    document.write.format(fmt).options(**options).mode("append").partitionBy("month").save(path)


def put_report(document: DataFrame, path: str, fmt: str = "json") -> None:
    """Files each document under its month and id; one that is there already is replaced.

    A job that runs again, in part or as a whole, leaves one copy of each document. Documents with
    other ids, of the same month too, are not touched, and nothing is read first.
    """
    writer = document.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FILED).format(fmt).save(path)


def read_reports(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """All filed documents; `schema` is that of the documents, since a month looks like a date."""
    return spark.read.schema(schema).format(fmt).load(path)


def report_figures(documents: DataFrame) -> DataFrame:
    """Long form: one row for each document, symbol and figure that is not null.

    Correlations are named `corr_<other symbol>`.
    """
    named = documents.select(*FILED, F.explode("metrics").alias("symbol", "m"))
    groups = {"var": documents.schema["metrics"].dataType.valueType["var"].dataType.names,
              "statistics": documents.schema["metrics"].dataType.valueType["statistics"].dataType.names}
    pairs = [(n, F.col(f"m.{g}.{n}")) for g, names in groups.items() for n in names]
    pairs.append(("tracking_error", F.col("m.tracking_error")))
    entries = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in pairs])
    figures = named.select(*FILED, "symbol", F.inline(entries))
    rows = documents.select(*FILED, F.explode("correlation_matrix").alias("symbol", "row"))
    cells = rows.select(*FILED, "symbol", F.explode("row").alias("other", "value"))
    corr = cells.select(*FILED, "symbol", F.concat(F.lit("corr_"), "other").alias("name"), "value")
    return figures.unionByName(corr).where("value is not null")


def write_backup(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").json(path)
