"""Makes this library importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import ledgerstrata


def make_importable(spark: SparkSession) -> None:
    """Send the library's source to all executors, once per Spark context.

    Operators run library functions in Python workers, which must be able to import them wherever
    the driver was started. Where the library is installed on all machines this is not needed.
    """
    context = spark.sparkContext
    if getattr(context, "_ledgerstrata_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(ledgerstrata.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerstrata-"), "ledgerstrata.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)  # the driver serves it to the executors
    context._ledgerstrata_shipped = True
