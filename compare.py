"""Time each chosen form next to the plain one, on the sources of `bench.py`.

The plain forms filter once per label and unite the results, de-duplicate family by family, mirror
by union and repartition to a fixed width. Broadcast joins are off, as beyond a small size they are
anyway. Prints a Markdown table of median seconds, leaf scans, shuffles, broadcasts and shuffled
bytes, the last from Spark's event log in a temporary folder.
"""

from __future__ import annotations

import json
import re
import statistics
import sys
import tempfile
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from bench import CPUS, RUNS, SF_DIR, seconds, stored_sources
from checks.queries import LOAD_DAY
from pairloom import operators as op
from pairloom import plans, sources
from pairloom.operators.pairs import _ranked
from pairloom.plans.feeds import _described
from pairloom.plans.library import _match_tracks, _reject_tracks
from pairloom.functions import parts_to_epoch, to_epoch_int
from pairloom.rules import (
    DOMAIN_FEEDS,
    DOMAINS,
    DROPPED_COMPANY,
    DROPPED_WORKFLOWS,
    REJECT,
    REVIEW_SOURCE,
    Track,
    answer_tracks,
    queue_tracks,
)
from pairloom.schema import JOIN_KEYS, LABELLED, PAIR, REVIEW, SIDES, conform, union_conformed
from pairloom.scratch import scratch_dir
from pairloom.settings import METHOD_LIMIT

KEYS = list(JOIN_KEYS)


# ---- Plain forms ------------------------------------------------------------------------

def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def filter_and_unite(df: DataFrame, tracks: list[Track]) -> DataFrame:
    branches = []
    for track in tracks:
        earlier = F.lit(False)
        for rule in track:
            branches.append(op.tag(df.where(rule.when & ~earlier), **rule.labels))
            earlier = earlier | F.coalesce(rule.when, F.lit(False))
    return union_all(branches)


def mirror_by_union(df: DataFrame) -> DataFrame:
    other = {a: b for s in SIDES for a, b in (s, s[::-1])}
    return df.unionByName(df.select(*[F.col(other.get(c, c)).alias(c) for c in df.columns]))


def plain_library(library: DataFrame, tracks: list[Track]) -> DataFrame:
    rows = op.exclude_values(library, "company_code", [DROPPED_COMPANY])
    keyed = op.add_keys(op.add_uuids(op.fill_blank(rows)))
    return conform(filter_and_unite(keyed, tracks).withColumnRenamed(
        "match_date", "match_timestamp"), PAIR)


def plain_reviews(reviews: list[DataFrame]) -> DataFrame:
    rows = op.exclude_values(op.fill_blank(union_conformed(reviews, REVIEW)), "workflow",
                             DROPPED_WORKFLOWS)
    keyed = op.add_keys(op.add_uuids(rows))
    routed = filter_and_unite(filter_and_unite(keyed, answer_tracks()), queue_tracks())
    stamped = routed.withColumn("match_timestamp", to_epoch_int("match_date"))
    return conform(op.tag(stamped, match_source=REVIEW_SOURCE), PAIR)


def plain_feed(pairs: DataFrame, feed: str) -> DataFrame:
    pairs = op.rename_cols(pairs, {"scores": "score"})
    if feed in DOMAIN_FEEDS:
        pairs = union_all([pairs.where(F.col("domain") == d) for d in DOMAINS])
    once = op.canonical_pair(pairs.dropDuplicates(["uuid_a", "uuid_b"]))
    twice = once.dropDuplicates(["uuid_a", "uuid_b"]).withColumns({
        "match_timestamp": parts_to_epoch("day", "month", "year"), "segment": F.col("domain")})
    return conform(_described(twice, feed, "upc"), PAIR)


def plain_warehouse(library, reviews, feeds) -> DataFrame:
    answers = plain_reviews(reviews)
    matches = union_all([plain_library(library, _match_tracks(False)),
                         answers.where(F.col("type") != REJECT).dropDuplicates(KEYS),
                         *(plain_feed(p, n) for n, p in feeds.items())])
    matches = op.rewrite_alias(matches.dropDuplicates(KEYS)).dropDuplicates(KEYS)
    rejects = plain_library(library, _reject_tracks(False)).unionByName(
        answers.where(F.col("type") == REJECT).dropDuplicates(KEYS)).dropDuplicates(KEYS)
    both = op.stamp_load_date(matches.unionByName(rejects), LOAD_DAY)
    return mirror_by_union(both).repartition(80)


def dedupe_by_row_number(df: DataFrame) -> DataFrame:
    order = _ranked(("priority", "match_timestamp"), [c for c in df.columns if c not in KEYS])
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy(*order))
    return df.withColumn("place", place).where("place = 1").drop("place")


def dedupe_by_min_by(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c not in KEYS]
    least = F.min_by(F.struct(*others), F.struct(*_ranked(("priority", "match_timestamp"), others)))
    return df.groupBy(*KEYS).agg(least.alias("best")).select(*KEYS, "best.*")


def earliest_by_rank(df: DataFrame) -> DataFrame:
    place = F.rank().over(Window.partitionBy(*KEYS).orderBy("match_timestamp"))
    return df.withColumn("place", place).where("place = 1").drop("place")


def prune_twice(matches: DataFrame, rejects: DataFrame) -> DataFrame:
    once = op.prune_rejected(matches, rejects, undirected=False)
    return op.prune_rejected(once, op.mirror_pairs(rejects), undirected=False)


def hot(pairs: DataFrame) -> DataFrame:
    """The same rows with every third one moved to a single pair."""
    third = F.pmod(F.xxhash64(*pairs.columns), F.lit(3)) == 0
    return pairs.withColumns({k: F.when(third, "-<>a<>b").otherwise(F.col(k)) for k in KEYS})


# ---- Measuring --------------------------------------------------------------------------

def session(log_dir: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("compare")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.hugeMethodLimit", METHOD_LIMIT)
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.dir", f"file://{log_dir}")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffled_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written, by job description."""
    out, stage_of = {}, {}
    for path in sorted(Path(log_dir).rglob("*")):
        if not path.is_file():
            continue
        for line in path.open():
            if not line.startswith("{"):
                continue
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = (event.get("Properties") or {}).get("spark.job.description")
                stage_of.update({s: name for s in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
                name = stage_of.get(event["Stage ID"])
                written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                out[name] = out.get(name, 0) + written
    return out


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(log_dir)
    inputs = stored_sources(spark, SF_DIR)
    raw = [inputs[k] for k in ("library", "reviews", "feeds")]
    pairs, hot_pairs = inputs["pairs"], hot(inputs["pairs"])
    rejects, matches = pairs.where(F.col("type") == REJECT), pairs.where(F.col("type") != REJECT)
    stored = scratch_dir(spark, "rows")
    plans.warehouse_from_sources(*raw, LOAD_DAY).write.parquet(stored)
    rows = spark.read.parquet(stored)
    order = ("priority", "match_timestamp")
    forms = {
        "warehouse: one pass": plans.warehouse_from_sources(*raw, LOAD_DAY),
        "warehouse: plain": plain_warehouse(*raw),
        "library: routed": plans.library_pairs(inputs["library"]),
        "library: filters united": plain_library(
            inputs["library"], _match_tracks(False) + _reject_tracks(False)),
        "mirror: inline": op.mirror_pairs(pairs),
        "mirror: union": mirror_by_union(pairs),
        "dedupe: min of struct": op.dedupe_pairs(pairs, order=order),
        "dedupe: min_by": dedupe_by_min_by(pairs),
        "dedupe: row_number": dedupe_by_row_number(pairs),
        "dedupe, hot pair: min of struct": op.dedupe_pairs(hot_pairs, order=order),
        "dedupe, hot pair: min_by": dedupe_by_min_by(hot_pairs),
        "dedupe, hot pair: row_number": dedupe_by_row_number(hot_pairs),
        "earliest: join back": op.earliest_per_pair(pairs),
        "earliest: rank": earliest_by_rank(pairs),
        "prune: one join": op.prune_rejected(matches, rejects),
        "prune: two joins": prune_twice(matches, rejects),
    }
    runs = {n: (df, lambda df=df: df.write.format("noop").mode("overwrite").save())
            for n, df in forms.items()}
    for fmt in ("parquet", "csv"):
        target = scratch_dir(spark, fmt)
        runs[f"write: {fmt}"] = (rows, lambda fmt=fmt, target=target: sources.write_warehouse(
            rows, target, fmt))
    lines = {}
    for name, (df, run) in runs.items():
        spark.sparkContext.setJobDescription("warm-up")
        seconds(run)
        spark.sparkContext.setJobDescription(name)
        time = statistics.median(seconds(run) for _ in range(RUNS))
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = re.findall(r"(?<!Broadcast)Exchange (?!Single)\w+", plan)
        lines[name] = (time, plan.count("FileScan"), len(shuffles), plan.count("BroadcastExchange"))
    spark.stop()
    moved = shuffled_bytes(log_dir)
    print("| form | seconds | scans | shuffles | broadcasts | MB shuffled |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, (time, scans, shuffles, broadcasts) in lines.items():
        mb = moved.get(name, 0) / RUNS / 1e6
        print(f"| {name} | {time:.2f} | {scans} | {shuffles} | {broadcasts} | {mb:.1f} |")


if __name__ == "__main__":
    sys.exit(main())
