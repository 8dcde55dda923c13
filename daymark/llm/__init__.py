"""Operators of a training-data pipeline over document and vector tables.

Nothing else in the library imports this subpackage.  Each operator lives in
a module of its own; ``catalog`` holds the registered queries.
"""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, so that
    their Python workers can import it without an installation there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="daymark-src-")) / "daymark_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
