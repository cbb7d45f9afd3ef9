"""Makes this package importable on executors that do not have the repository on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    name = Path(tempfile.mkdtemp(prefix="tagloom-ship-")) / "tagloom_package.zip"
    with zipfile.ZipFile(name, "w") as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = Path(at) / f
                    z.write(full, full.relative_to(root.parent))
    sc.addPyFile(str(name))
    _shipped.add(sc.applicationId)
