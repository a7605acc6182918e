"""Partitioned writes of warehouse rows, and reading them back."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.projections import load_date_parts, stamp_load_date
from ..schema import JOIN_KEYS, LOAD_DATE, WAREHOUSE
from ..scratch import remove, scratch_dir

#: Reader and writer options by format, which a table keeps as its own. CSV must tell null from
#: blank, and keep quotes, backslashes, outer blanks and line breaks as they are. With line breaks
#: inside values a file cannot be split, so it is read by one task; tasks write moderate files.
#: Text repeats every name and store, so it is packed (JSON to less than a tenth). A packed file cannot
#: be split either, so that none holds more than a million rows.
PACKED = {"compression": "gzip", "maxRecordsPerFile": "1000000"}
#: Parquet of warehouse rows takes 38 % less by this codec than by Spark's default one, in the same time.
COLUMNAR = {"compression": "zstd"}
_OPTIONS = {
    "parquet": COLUMNAR,
    "json": PACKED,
    "csv": {"nullValue": "\\N", "escape": '"', "multiLine": "true", "lineSep": "\n",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **PACKED},
}
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def few_partitions(spark: SparkSession, writers: int = 4) -> Iterator[None]:
    """Let a task keep files of some partitions open, instead of sorting its rows by partition.

    A task that meets more partitions than `writers` sorts the rest of its rows.
    """
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(writers))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Even out partitions ahead of a write.

    With columns, rows of equal values stay together as far as the advisory partition size
    allows; adaptive execution splits the partition of a value that is too large, which
    `repartition` on the columns would send to one task.
    """
    return df.hint("rebalance", *columns)


def order_for_lookup(df: DataFrame, columns: Sequence[str] = JOIN_KEYS[:1],
                     within: Sequence[str] = LOAD_DATE, stage: bool = True) -> DataFrame:
    """Rows in ranges of the columns, within a date, ahead of a write.

    A file then holds a narrow range, and so does each of its row groups, so that a lookup by key
    skips nearly all of them by their least and greatest values. Rows of equal keys may be cut into
    several ranges, by a hash of the row. The frame is stored in scratch first, as ranges are found
    by a sample, for which it would be computed once more. Without `stage` it is; that is for frames
    that are read from files as they are, which must stay until the result is written.
    """
    if stage:
        spark, folder = df.sparkSession, scratch_dir(df.sparkSession, "lookup")
        df.write.options(**COLUMNAR).parquet(folder)
        df = spark.read.schema(df.schema).parquet(folder)
    row = F.xxhash64(*df.columns)
    return df.repartitionByRange(*within, *columns, row).sortWithinPartitions(*within, *columns)


def replace_day(df: DataFrame, folder: str, day: datetime.date | str, count: int) -> None:
    """Write the frame's `count` rows as one load date of a folder; other dates stay.

    No rows leave no partition of that date, also where an earlier run of the day wrote one.
    """
    if count:
        write_warehouse(stamp_load_date(df, day), folder)
        return
    names = [f"{k}={v}" for k, v in load_date_parts(day).items()]
    remove(df.sparkSession, "/".join([folder.rstrip("/"), *names]))


def write_warehouse(df: DataFrame, target: str, fmt: str = "parquet",
                    mode: str = "overwrite_partitions", partitions: Sequence[str] = LOAD_DATE,
                    spread: bool = False, path: str | None = None) -> None:
    """Write to a directory (`target` has a slash) or a catalog table, by partition.

    `overwrite_partitions` replaces the partitions the frame has rows for and leaves the others,
    so a rerun of a day does not append it twice; other modes are Spark's. A frame of many
    dates should be `spread`, or every task writes a file per date; with a single date the
    partitions of its last shuffle serve as they are. `path` is where a new table's files go.
    """
    if spread:
        df = rebalance(df, *partitions)
    spark = df.sparkSession
    dynamic = mode == "overwrite_partitions"
    writer = df.write.format(fmt).options(**_OPTIONS.get(fmt, {}))
    if "/" in target:
        if dynamic:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode(mode)
        writer.partitionBy(*partitions).save(target)
    elif dynamic and spark.catalog.tableExists(target):
        ordered = df.select(*spark.table(target).columns)
        before = spark.conf.get(_OVERWRITE)
        spark.conf.set(_OVERWRITE, "dynamic")
        try:
            ordered.write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(_OVERWRITE, before)
    else:
        if path is not None:
            writer = writer.option("path", path)
        writer.mode("error" if dynamic else mode).partitionBy(*partitions).saveAsTable(target)


def _one_of(types: Sequence[str]) -> Column:
    return F.coalesce(F.col("type").isin(*types), F.lit(False))


def write_split(df: DataFrame, targets_by_type: Mapping[tuple[str, ...], str],
                fmt: str = "parquet", mode: str = "overwrite_partitions",
                stage: str | None = None, rest: str | None = None,
                spread: bool = False) -> None:
    """Write each group of types to a target of its own, and other or missing types to `rest`.

    The frame is computed once, into the folder `stage` (by default one in the cluster's shared
    scratch folder, which is deleted afterwards), laid out by type; each target then takes its
    types from there and reads no other. Rows of no group are counted on the way: without `rest`
    they raise an error before any target is written. `spread` is for frames of many dates, as
    in `write_warehouse`; the load date is read back as a column, by which rows of a few dates are not
    sorted either.
    """
    spark = df.sparkSession
    listed = [t for types in targets_by_type for t in types]
    folder = stage or scratch_dir(spark, "split")
    seen = Observation("split")
    with few_partitions(spark):
        (df.observe(seen, F.count_if(~_one_of(listed)).alias("others"))
         .write.mode("overwrite").options(**COLUMNAR).partitionBy("type").parquet(folder))
    try:
        if rest is None and seen.get["others"]:
            raise ValueError(f"{seen.get['others']} rows have a type of no target")
        staged = spark.read.schema(df.schema).parquet(folder).select(*df.columns)
        parts = [(_one_of(types), target) for types, target in targets_by_type.items()]
        if rest is not None:
            parts.append((~_one_of(listed), rest))
        with few_partitions(spark):
            for rows, target in parts:
                write_warehouse(staged.where(rows), target, fmt, mode, spread=spread)
    finally:
        if stage is None:
            remove(spark, folder)


def read_warehouse(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: StructType = WAREHOUSE) -> DataFrame:
    """Rows back from a directory. The schema keeps partition values as text, zeros included."""
    return (spark.read.schema(schema).format(fmt).options(**_OPTIONS.get(fmt, {}))
            .load(path).select(*schema.names))
