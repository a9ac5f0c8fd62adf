"""Make the package importable in the Python workers of any cluster.

Operators that run Python on executors (HTML extraction, KNN distances)
send functions that refer to this package; workers must be able to import
it. ``ensure_importable`` zips the package once per SparkContext and ships it
with ``SparkContext.addPyFile`` (Spark serves the file to every executor).
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def _zip_package() -> str:
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    return out


def ensure_importable(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    sc.addPyFile(_zip_package())
    _SHIPPED.add(key)
