"""Scratch folders for written copies, on storage that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="pairloom-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's checkpoint folder.

    The setting is only read, as a running session may not change it. Without it a local session
    gets a temporary folder of this machine, and a cluster an error.
    """
    run = spark.sparkContext.applicationId
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        base = _local_folder(run)
    return f"{base.rstrip('/')}/pairloom/{run}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever storage it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
