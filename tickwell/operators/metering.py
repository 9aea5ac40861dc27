"""Row counts that travel with a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metered(df: DataFrame, name: str, **counts: Column) -> DataFrame:
    """Count rows, and rows meeting each condition, as observed metrics of the query.

    Filters are not pushed below an observation. After an expensive parse that is wanted:
    pushed down, a filter on a parsed column repeats the whole parse for every use of it.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(condition).alias(label) for label, condition in counts.items()]
    return df.observe(name, *metrics)
