"""Feeds that arrive in parts: each part is written, then the streams read what is new and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def replay(arriving: DataFrame, path: str, parts: int, run: Callable[[], None]) -> None:
    """Writes the rows of `arriving` part by part into the folder `path` and calls `run` after each.

    A part is a batch of its own for a stream that starts from its checkpoint every time, so state,
    watermark and last prices are taken up again as often as there are parts.
    """
    for part in range(parts):
        arriving.where(arriving["part"] == part).drop("part").write.mode("append").parquet(path)
        run()


def follow(arriving: DataFrame, path: str) -> DataFrame:
    """The folder as a stream of all rows that are new."""
    return arriving.sparkSession.readStream.schema(arriving.drop("part").schema).parquet(path)
