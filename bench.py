"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8) is the
number of local cores. The sources are written once as Parquet, outside the timing; each query
then is planned and run in full over them, its rows going to Spark's `noop` sink. Its time is the
median of three runs, taken after two rounds of all queries that warm the JVM.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import feeds, library, review_sources
from checks.queries import LOAD_DAY
from pairloom import operators as op
from pairloom import plans, sources
from pairloom.rules import REJECT
from pairloom.scratch import scratch_dir
from pairloom.settings import METHOD_LIMIT

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = 2
RUNS = 3


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.hugeMethodLimit", METHOD_LIMIT)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored_sources(spark: SparkSession, sf_dir: str) -> dict:
    """Library, reviews, feeds, and the labelled pairs of them all, each in files of its own."""
    tasks = int(CPUS)

    def stored(name: str, frame: DataFrame) -> DataFrame:
        path = scratch_dir(spark, name)
        frame.repartition(tasks).write.parquet(path)
        return spark.read.parquet(path)
    out = {
        "library": stored("library", library(spark, sf_dir)),
        "reviews": [stored("review", r) for r in review_sources(spark, sf_dir)],
        "feeds": {n: stored(n, f) for n, f in feeds(spark, sf_dir).items()},
    }
    out["pairs"] = stored("pairs", op.combine(
        [plans.library_pairs(out["library"]), plans.review_pairs(out["reviews"]),
         *(plans.feed_pairs(f, n) for n, f in out["feeds"].items())]))
    return out


def headline(spark: SparkSession, inputs: dict) -> dict:
    raw = [inputs[k] for k in ("library", "reviews", "feeds")]
    library_rows, review_rows, feed_rows = raw
    pairs = inputs["pairs"]
    rejects, matches = pairs.where(F.col("type") == REJECT), pairs.where(F.col("type") != REJECT)
    target = scratch_dir(spark, "warehouse")

    def warehouse(**options) -> DataFrame:
        return plans.warehouse_from_sources(*raw, LOAD_DAY, **options)
    frames = {
        "warehouse": warehouse,
        "warehouse_pruned": lambda: warehouse(prune=True),
        "warehouse_undirected": lambda: warehouse(undirected=True),
        "library_pairs": lambda: plans.library_pairs(library_rows),
        "library_matches": lambda: plans.library_matches(library_rows),
        "review_matches": lambda: plans.review_matches(review_rows),
        "feed_matches_upc": lambda: plans.feed_matches(feed_rows["upc"], "upc"),
        "feed_matches_transitive": lambda: plans.feed_matches(feed_rows["transitive"],
                                                              "transitive"),
        "route_pets": lambda: op.route_pets(library_rows),
        "route_reject_source": lambda: op.route_reject_source(library_rows),
        "dedupe_pairs": lambda: op.dedupe_pairs(pairs, order=("priority", "match_timestamp")),
        "earliest_per_pair": lambda: op.earliest_per_pair(pairs),
        "prune_rejected": lambda: op.prune_rejected(matches, rejects),
        "mirror_pairs": lambda: op.mirror_pairs(pairs),
    }
    runs = {name: lambda frame=frame: frame().write.format("noop").mode("overwrite").save()
            for name, frame in frames.items()}
    return {**runs, "write_warehouse": lambda: sources.write_warehouse(warehouse(), target)}


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    runs = headline(spark, stored_sources(spark, SF_DIR))
    for _ in range(WARM_UP):
        for run in runs.values():
            run()
    times = {name: round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
             for name, run in runs.items()}
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"))}))
    spark.stop()


if __name__ == "__main__":
    main()
