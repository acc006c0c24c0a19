"""Sending this package's code to the Python workers."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give every executor a copy of the package, once per application (Spark serves the file from the driver)."""
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        _SENT.add(context.applicationId)
        package = pathlib.Path(__file__).resolve().parent.parent
        archive = pathlib.Path(tempfile.mkdtemp(prefix="chartloom-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(str(archive))
    return spark
