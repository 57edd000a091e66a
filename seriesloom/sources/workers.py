"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers, once a session, unless they find it anyway (it is on
    PYTHONPATH, or the driver runs in its folder)."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, sc = os.path.dirname(package), spark.sparkContext
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.realpath(root) in [*known, os.path.realpath(os.getcwd())] or getattr(sc, "seriesloom_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="seriesloom-"), "seriesloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc.seriesloom_shipped = True
