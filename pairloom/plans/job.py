"""The whole job on catalog tables and JSON folders: scan, build, check, publish."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..rules import DOMAIN_FEEDS, DOMAINS, PREFERRED_IDS
from ..schema import LABELLED, REVIEW
from ..scratch import remove, scratch_dir
from ..settings import MOST_PARTITIONS, planned_bytes, sized_for
from ..sources import (
    Limit,
    check_limits,
    few_partitions,
    latest_partition,
    observed_metrics,
    publish_day,
    replace_day,
    scan_domains,
    scan_json_dir,
    scan_table,
    stage_json,
    table_partitions,
    write_warehouse,
)
from .warehouse import is_bare, labelled_pairs, warehouse_from_labelled

#: Options of `warehouse_from_sources` that say which labelled pairs there are.
_SOURCE_OPTIONS = ("prefer", "strict", "domains", "drop_half_null", "dropped_workflows")
#: Bad JSON lines that a day is still loaded with.
BAD_LINES = Limit("bad_lines", most=0.01, share=True)


def split_bare(labelled: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Pairs with ids, pairs without, and how many the latter are: one pass over the sources."""
    spark, folder = labelled.sparkSession, scratch_dir(labelled.sparkSession, "labelled")
    seen = Observation("bare")
    with few_partitions(spark):
        (labelled.withColumn("_bare", is_bare()).observe(seen, F.count_if("_bare").alias("bare"))
         .write.partitionBy("_bare").parquet(folder))
    stored = spark.read.schema(StructType(
        [*LABELLED.fields, StructField("_bare", BooleanType())])).parquet(folder)
    return (stored.where("not _bare").drop("_bare"), stored.where("_bare").drop("_bare"),
            seen.get.get("bare", 0))


def _write_folder(rows: DataFrame, folder: str, fmt: str, limits: Sequence[Limit]) -> int:
    """Write a day's rows to a folder; with limits, by way of a counted copy in scratch."""
    spark = rows.sparkSession
    rows, seen = observed_metrics(rows)
    if not limits:
        write_warehouse(rows, folder, fmt)
        return seen.get.get("row_count", 0)
    stage = scratch_dir(spark, "checked")
    rows.write.parquet(stage)
    metrics = seen.get or dict.fromkeys((limit.metric for limit in limits), 0) | {"row_count": 0}
    try:
        check_limits(metrics, limits)
        write_warehouse(spark.read.schema(rows.schema).parquet(stage), folder, fmt)
    finally:
        remove(spark, stage)
    return metrics["row_count"]


def load_warehouse(spark: SparkSession, domain: str, day: datetime.date | str, *, library: str,
                   review_tables: Sequence[str] = (), review_folders: Sequence[str] = (),
                   feeds: Mapping[str, str], target: str, fmt: str = "parquet",
                   quarantine: str | None = None, bad_lines: str | None = None,
                   bad_line_limit: Limit = BAD_LINES, limits: Sequence[Limit] = (),
                   lookup: Sequence[str] = (), input_bytes: int | None = None,
                   most_partitions: int = MOST_PARTITIONS, **options) -> int:
    """Build the day's warehouse rows and publish them as `target`; returns their number.

    Reads the newest `load_date` of the library table, the review tables and JSON folders, and the
    feed tables by feed name. The domain decides which id join keys prefer; `options` are those of
    `warehouse_from_sources`.

    A table as target shows the day in one step, after its rows have been counted and kept to
    `limits` (see `publish_day`, also for `lookup`); a folder (with a slash) is written to once
    they have been counted. A broken limit raises LimitBreached, and the target stays as it was.

    Two folders take what does not go to the warehouse, by load date; other dates of them stay.
    `quarantine`: pairs with a product that has no id. Each source is then still scanned once, and
    the labelled pairs are stored. `bad_lines`: lines of the review folders that are no JSON
    object, which else fail the job; beyond `bad_line_limit` they do so here too, and nothing is
    written.

    Tasks are sized by `input_bytes`, by default what the planner expects of the sources, or as
    the session says where that is not known; the settings are as before afterwards.
    """
    dates = table_partitions(spark, library, {"load_date": "string"})
    newest = latest_partition(scan_table(spark, library), ["load_date"], partitions=dates)
    reviews = [scan_table(spark, t) for t in review_tables]
    if bad_lines is None:
        reviews += [scan_json_dir(spark, f, REVIEW) for f in review_folders]
    elif review_folders:
        good, bad, lines = stage_json(spark, list(review_folders), REVIEW)
        check_limits(lines, [bad_line_limit])
        replace_day(bad, bad_lines, day, lines["bad_lines"])
        reviews.append(good)
    limits_of_feeds = options.get("domains")
    pairs = {feed: scan_table(spark, table)
             if limits_of_feeds is None and feed not in DOMAIN_FEEDS
             else scan_domains(spark, table, limits_of_feeds or DOMAINS)
             for feed, table in feeds.items()}
    options.setdefault("prefer", PREFERRED_IDS.get(domain, "upc"))
    if input_bytes is None:
        input_bytes = planned_bytes(newest, *reviews, *pairs.values())
    of_sources = {k: v for k, v in options.items() if k in _SOURCE_OPTIONS}
    of_pairs = {k: v for k, v in options.items() if k not in _SOURCE_OPTIONS}
    drop_bare = of_pairs.pop("drop_bare", False)
    with sized_for(spark, input_bytes, most_partitions):
        labelled = labelled_pairs(newest, reviews, pairs, **of_sources)
        if quarantine is not None:
            labelled, bare, count = split_bare(labelled)
            replace_day(bare, quarantine, day, count)
        elif drop_bare:
            labelled = labelled.where(~is_bare())
        rows = warehouse_from_labelled(labelled, day, **of_pairs)
        if "/" in target:
            return _write_folder(rows, target, fmt, limits)
        return publish_day(rows, target, day, fmt=fmt, limits=limits, lookup=lookup)["row_count"]
