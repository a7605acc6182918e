"""Ready a session: send this package to the executors' Python workers, and bound their batches."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_sent: set[str] = set()
#: Texts vary from a word to megabytes, so batches are bounded by bytes, on both sides of the pipe.
_BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Add the package to the application's files, once; Spark serves it from the driver.

    The session's Arrow batches get at most 4 MB, unless it has a bound in plain bytes below that.
    """
    bound = spark.conf.get(_BATCH_SETTING).rstrip("bB")
    if not bound.isdigit() or int(bound) > _BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(_BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="pairloom-"), "pairloom_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
