"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, unless their path has it already."""
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep) + [os.getcwd()]
    if context.applicationId in _SHIPPED or _ROOT in map(os.path.abspath, filter(None, known)):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="rookery-ship-"), "rookery.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(_ROOT, "rookery")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, _ROOT))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
