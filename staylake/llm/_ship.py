"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


#: Rows and bytes of an Arrow batch (value, Spark's own default that it replaces): texts are long, and a batch is held on both sides.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("2000", "10000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("2097152b", "67108864b"),
}


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files once (the workers fetch it from the driver)."""
    sc = spark.sparkContext
    for name, (value, default) in BATCH.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)
    if getattr(sc, "_staylake_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="staylake-"), "staylake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(_PACKAGE):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("staylake", os.path.relpath(full, _PACKAGE)))
    sc.addPyFile(path)
    sc._staylake_shipped = True
