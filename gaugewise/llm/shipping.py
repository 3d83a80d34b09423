"""Getting the package to Python workers that do not have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import gaugewise

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give every executor a copy of the package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(gaugewise.__file__))
    if os.path.isdir(root):  # else the package was itself shipped as an archive
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "gaugewise.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(archive)
    _shipped.add(context.applicationId)
