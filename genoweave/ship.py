"""The package for the Python workers of executors that have not got it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_MARK = "_genoweave_shipped"


def ship(spark: SparkSession) -> None:
    """Adds this package to the session's Python files, once for each context (as --py-files would)."""
    context = spark.sparkContext
    if getattr(context, _MARK, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="genoweave-py-")), "genoweave.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("genoweave", os.path.relpath(path, root)))
    context.addPyFile(target)
    setattr(context, _MARK, True)
