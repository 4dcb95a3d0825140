"""Making the package importable on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Needless, but harmless, where it is installed there or given with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="quillmill-")) / package.name
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
