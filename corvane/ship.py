"""Send the package to the Python workers of a session, once."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add a zip of this package to the session's Python files, so that any worker can import it.

    Workers often start in a folder, or on a machine, without the package. Spark's own file
    server hands the zip out; nothing is read from the driver's disk by an executor.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = os.path.dirname(os.path.abspath(__file__))
        if os.path.isdir(root):
            path = os.path.join(tempfile.mkdtemp(prefix="corvane-ship-"), "corvane.zip")
            with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
                for folder, _, names in os.walk(root):
                    for name in names:
                        if name.endswith(".py"):
                            full = os.path.join(folder, name)
                            out.write(full, os.path.join("corvane", os.path.relpath(full, root)))
            context.addPyFile(path)
    return spark
