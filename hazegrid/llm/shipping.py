"""The package for Python workers that don't have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to all executors, once an application, as `--py-files` does: Spark copies it to each."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(package):
        return  # this code came in such an archive itself
    path = os.path.join(tempfile.mkdtemp(prefix="hazegrid-code-"), "hazegrid_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
