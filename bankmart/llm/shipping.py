"""The package's code on every executor, as --py-files would put it there."""

from __future__ import annotations

import os
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once in an application.

    Operators with Python code call this, so that a session made without --py-files runs them.
    Nothing is done where the package was itself loaded from a shipped archive.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    folder = Path(SparkFiles.getRootDirectory()) / "code"
    folder.mkdir(exist_ok=True)
    archive = folder / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, os.path.join(package.name, file.relative_to(package)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
