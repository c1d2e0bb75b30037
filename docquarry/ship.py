"""The package's code for Python workers that don't have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for a context; nothing to do if it came from an archive itself."""
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if getattr(context, "_docquarry_shipped", False) or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="docquarry-code-"), "docquarry.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._docquarry_shipped = True
