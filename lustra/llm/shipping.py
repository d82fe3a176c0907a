"""Makes this package importable in Python workers that don't have it installed."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

_shipped: weakref.WeakSet[SparkContext] = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the executors once a session, as ``--py-files`` would.

    Spark serves the archive from the driver for as long as the session lasts.
    """
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context)
