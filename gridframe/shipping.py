"""Makes this package importable on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once per application.

    The archive lies in the driver's own temporary folder; Spark's file server
    hands it to executors, so no folder has to be shared.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gridframe-")) / "gridframe.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED[app] = str(archive)
