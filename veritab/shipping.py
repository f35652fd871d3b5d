"""Getting this package to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Serve the package's source to this application's executors, once.

    Workers import the functions that run in them. Where the package isn't
    installed on every machine, the driver hands out an archive of it.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="veritab-source-")) / "veritab.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(here.rglob("*.py")):
            z.write(file, Path(here.name) / file.relative_to(here))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
