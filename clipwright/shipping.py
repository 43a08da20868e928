"""The package on the executors, wherever the driver was started from."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


#: Spark's bound on the bytes of an Arrow batch, and the most that suits clips: several Python steps of a task each hold some batches
BATCH_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``MOST_BYTES`` in this session; a smaller setting stays. No operator's result depends on batches."""
    if int(spark.conf.get(BATCH_BYTES).rstrip("b")) > MOST_BYTES:
        spark.conf.set(BATCH_BYTES, f"{MOST_BYTES}b")


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once for each application; Spark hands the archive on."""
    small_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="clipwright-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "clipwright.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(root, f)
                    z.write(path, os.path.join("clipwright", os.path.relpath(path, here)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
