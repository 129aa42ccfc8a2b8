"""The package on the executors, where they do not have it: sent as a zip through Spark's own file server."""

from __future__ import annotations

import os
import tempfile
import zipfile

import quotewell
from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application. With `spark-submit --py-files` this is not needed, and does no harm."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(quotewell.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "quotewell.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("quotewell", os.path.relpath(full, root)))
    context.addPyFile(path)
    _sent.add(context.applicationId)
