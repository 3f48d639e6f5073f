"""Send this package to the Python workers of a session, once."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_NAME = "sensorpipe-code.zip"
#: Rows in an Arrow batch: texts are long, and Spark's own 10,000 of them fill a worker's memory.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Workers import the package from a zip file that Spark hands to every executor.

    Batches of texts are kept small, unless the session names a size of its own.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    context = spark.sparkContext
    if any(name == _NAME for name in context._python_includes):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, _NAME)
    with zipfile.ZipFile(path, "w") as out:
        for at, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
