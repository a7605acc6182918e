"""Session settings that follow the size of the input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_TASK_BYTES = 128 << 20
_LEAST_PARTITIONS = 200
#: Bytes of bytecode up to which HotSpot compiles a method. A fused stage beyond that would be
#: interpreted, which is slower than not fusing it.
METHOD_LIMIT = 8000
#: With more tasks than this on both sides of a shuffle, its block table outgrows the usual driver.
MOST_PARTITIONS = 100_000


def settings_for(input_bytes: int, most_partitions: int = MOST_PARTITIONS) -> dict[str, str]:
    """SQL settings for a job over `input_bytes`.

    Adaptive execution merges shuffle partitions but never adds any to an aggregation, so their
    first number must fit the data: a fixed 200 would put hundreds of GB in a task at 100 TB.
    A task gets 128 MB up to `most_partitions` of them (12 TB by default); beyond, tasks grow
    instead (1 GB at 100 TB, sorted with spilling), unless the driver can hold more. Merged partitions keep to the task size, so that writes yield no tiny files.
    """
    task_bytes = max(_TASK_BYTES, -(-input_bytes // most_partitions))
    partitions = max(_LEAST_PARTITIONS, -(-input_bytes // task_bytes))
    adaptive = "spark.sql.adaptive"
    return {
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.codegen.hugeMethodLimit": str(METHOD_LIMIT),
        f"{adaptive}.enabled": "true",
        f"{adaptive}.skewJoin.enabled": "true",
        f"{adaptive}.optimizeSkewsInRebalancePartitions.enabled": "true",
        f"{adaptive}.coalescePartitions.enabled": "true",
        f"{adaptive}.coalescePartitions.parallelismFirst": "false",
        f"{adaptive}.coalescePartitions.initialPartitionNum": str(partitions),
        f"{adaptive}.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
    }


def apply_settings(spark: SparkSession, input_bytes: int,
                   most_partitions: int = MOST_PARTITIONS) -> None:
    for name, value in settings_for(input_bytes, most_partitions).items():
        spark.conf.set(name, value)


def compiled_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings, and with fused stages that HotSpot compiles.

    The rules that label library rows make methods beyond `METHOD_LIMIT`, which the default
    settings would have interpreted for every row. A session that has the limit is returned as is.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) <= METHOD_LIMIT:
        return spark
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set(name, str(METHOD_LIMIT))
    return session


def planned_bytes(*frames: DataFrame) -> int | None:
    """Bytes that the frames read: the planner's file sizes, less pruned partitions.

    The planner does not know the size of a partitioned table that is read whole; that one is
    asked of the storage, which lists files but reads none. None if a frame comes from something
    else whose size is not known, as rows of the driver or of an RDD, or an outer database.
    """
    total = 0
    for frame in frames:
        spark = frame.sparkSession
        unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes").rstrip("bB"))
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            size = int(str(leaf.stats().sizeInBytes()))
            if size >= unknown:
                size = _stored_bytes(spark, leaf)
                if size is None:
                    return None
            total += size
    return total


def _stored_bytes(spark: SparkSession, leaf) -> int | None:
    """Bytes below the folders of a file relation or of a Hive table; None for other leaves."""
    kind = leaf.getClass().getSimpleName()
    if kind == "LogicalRelation" and (
            leaf.relation().getClass().getSimpleName() == "HadoopFsRelation"):
        found = leaf.relation().location().rootPaths()
        paths = [found.apply(i) for i in range(found.size())]
    elif kind == "HiveTableRelation":
        paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(leaf.tableMeta().location())]
    else:
        return None
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(hadoop).getContentSummary(p).getLength() for p in paths)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int | None,
              most_partitions: int = MOST_PARTITIONS) -> Iterator[None]:
    """The settings for an input, for as long as a job takes; the session's own if it is None."""
    if input_bytes is None:
        yield
        return
    wanted = settings_for(input_bytes, most_partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    apply_settings(spark, input_bytes, most_partitions)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
