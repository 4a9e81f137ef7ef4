"""Making the package importable in the Python workers of executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to all workers of the application, once.

    Needed where it is on the driver's path only.  The archive is made on the driver
    and Spark serves it from there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="package-")
    archive = shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
