"""Reading, storing and naming helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.sources.durable import cut, scratch
from tickwell.sources.tables import table

__all__ = ["cut", "free_name", "one_text_each", "partitions", "scratch", "settle", "slices", "table", "text_of"]

#: Characters that end a word wherever an operator speaks of words.
SPACES = "\\x20\\x09-\\x0D"


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"{name}_"
    return name


def partitions(spark: SparkSession) -> int:
    """The partition count that the cluster or user has set for shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, no lineage, any executor may go."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_text_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of the keys, with the first of its texts by hash.

    The texts of a key are folded before they move, so a key that very many rows share is a row of each
    task, no more.
    """
    return rows.groupBy(*keys).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def slices(texts: pa.Array, most_bytes: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about `most_bytes`; a longer text is a list of its own."""
    held: list[str] = []
    size = 0
    for value in texts:
        text = value.as_py() or ""
        if held and size + len(text) > most_bytes:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
