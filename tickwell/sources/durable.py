"""Shared-folder materialisation and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIR_SETTING = "spark.checkpoint.dir"
BROADCAST_SETTING = "spark.tickwell.broadcastRows"
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder: there the driver and the
    executors are one process.
    """
    configured = spark.conf.get(DIR_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {DIR_SETTING} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickwell-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs restart from files instead of the whole lineage."""
    context, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only after counting; a larger side is left to a shuffle join."""
    if max_rows is None:
        max_rows = int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_ROWS)))
    if df.limit(max_rows + 1).count() > max_rows:
        return df
    return F.broadcast(df)
