"""Sends this package to the executors, which need it for every Python worker."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tickwell

SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Adds the package to the workers' path, once per application.

    The archive is made on the driver and handed out by Spark, so nothing has to be installed
    on the executors. Jobs started through `spark-submit --py-files` may skip this call.
    """
    context = spark.sparkContext
    if context.applicationId in SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tickwell.__file__))
    # Spark reads the archive whenever a new executor starts, so it stays until the driver ends.
    folder = tempfile.TemporaryDirectory(prefix="tickwell-package-")
    archive = os.path.join(folder.name, "tickwell_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for at, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(at, name)
                out.write(path, os.path.join("tickwell", os.path.relpath(path, root)))
    context.addPyFile(archive)
    SHIPPED[context.applicationId] = folder
