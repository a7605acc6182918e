"""Scans, lookups and sinks on written data."""

import json
import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pairloom import sources
from pairloom.operators import stamp_load_date
from pairloom.schema import PAIR, REVIEW, WAREHOUSE, conform, resolve_types
from pairloom.scratch import scratch_dir


def multiset(rows):
    return Counter(tuple(r) for r in rows)


def pair(spark, *uuids, kind="exact_match", score="1"):
    return spark.createDataFrame(
        [(u, "b", f"k{u}", "kb", score, "s<>t", None, 5, "upc", kind, "pets") for u in uuids], PAIR)


def partition_dirs(path):
    return sorted(os.path.relpath(d, path) for d, _, files in os.walk(path)
                  if any(f.startswith("part-") for f in files))


# ---- Types ------------------------------------------------------------------------------

def test_conform_orders_and_casts_without_raising(spark):
    df = spark.createDataFrame([("x", 7, "y")], "b string, a int, extra string")
    schema = StructType([StructField("a", StringType()), StructField("b", IntegerType())])
    assert conform(df, schema).collect() == [("7", None)]
    assert conform(df, schema).columns == ["a", "b"]


def test_conform_needs_all_columns(spark):
    with pytest.raises(Exception, match="uuid_a"):
        conform(spark.range(1), PAIR)


def test_resolve_types_leaves_other_columns(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "y")], "n string, other string")
    assert resolve_types(df, {"n": "int"}).collect() == [(1, "x"), (None, "y")]


def test_json_dir_reads_mixed_types_in_subfolders(spark, tmp_path):
    for folder, date in (("a", 5), ("a/b", "6"), ("c", "bad"), ("c", None)):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        row = {"base_sku": 7, "score": 0.5, "match_date": date, "unknown": [1]}
        (tmp_path / folder / f"{date}.json").write_text(json.dumps(row) + "\n")
    got = sources.scan_json_dir(spark, str(tmp_path), REVIEW)
    assert got.schema == REVIEW
    assert multiset(got.select("base_sku", "score", "match_date").collect()) == multiset(
        [("7", "0.5", 5), ("7", "0.5", 6), ("7", "0.5", None), ("7", "0.5", None)])


def test_json_numbers_reach_whole_columns(spark, tmp_path):
    dates = ["1600000000", "1600000000.0", "1.6E9", "1600000000.75", '"1600000000.0"', "-5.0", "1e400"]
    (tmp_path / "x.json").write_text("".join(f'{{"match_date": {d}}}\n' for d in dates))
    got = sources.scan_json_dir(spark, str(tmp_path), REVIEW).select("match_date").collect()
    assert multiset(got) == multiset([(1600000000,)] * 5 + [(-5,), (None,)])


def test_json_lines_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"score": "1"}\n{"score": "2", "workf\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        sources.scan_json_dir(spark, str(tmp_path), REVIEW).collect()
    kept = sources.scan_json_dir(spark, str(tmp_path), REVIEW, bad_lines="line")
    assert multiset(kept.select("score", "line").collect()) == multiset(
        [("1", None), (None, '{"score": "2", "workf')])
    assert kept.columns == [*REVIEW.names, "line"]


def test_small_files_share_tasks(spark, tmp_path):
    spark.range(64).repartition(64).write.json(str(tmp_path / "x"))
    schema = StructType([StructField("id", StringType())])
    packing = spark.newSession()
    sources.pack_small_files(packing, target_bytes=1 << 20, file_cost_bytes=32 << 10)
    got = sources.scan_json_dir(packing, str(tmp_path / "x"), schema)
    assert got.count() == 64
    assert got.select(F.spark_partition_id()).distinct().count() <= 8


# ---- Newest partition -------------------------------------------------------------------

@pytest.fixture
def dated(spark, tmp_path):
    rows = [(y, m, d, r, f"{y}-{m}-{d}-{r}") for y, m, d, r in
            ((2023, 12, 31, 9), (2024, 9, 30, 1), (2024, 10, 2, 1), (2024, 10, 2, 12),
             (2024, 10, 2, 3))]
    path = str(tmp_path / "dated")
    (spark.createDataFrame(rows, "year int, month int, day int, run_no int, v string")
     .write.partitionBy("year", "month", "day", "run_no").parquet(path))
    return path


def test_latest_by_number_not_by_text(spark, dated):
    df = spark.read.parquet(dated)
    got = sources.latest_partition(df, ["year", "month", "day", "run_no"])
    assert [r.v for r in got.collect()] == ["2024-10-2-12"]
    assert sources.latest_partition(df, ["year", "month", "day"]).count() == 3
    within = sources.latest_partition(df, ["year", "month"], within="month < 10")
    assert [r.v for r in within.collect()] == ["2024-9-30-1"]


def test_latest_reads_one_partition(spark, dated):
    df = spark.read.parquet(dated)
    got = sources.latest_partition(df, ["year", "month", "day", "run_no"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{c}#" in filters for c in ("year", "month", "day", "run_no"))
    assert got.select(F.input_file_name()).distinct().count() == 1


def test_latest_with_known_value_and_when_missing(spark, dated):
    df = spark.read.parquet(dated)
    got = sources.latest_partition(df, ["year", "month"], value=[2024, 9])
    assert [r.v for r in got.collect()] == ["2024-9-30-1"]
    with pytest.raises(LookupError):
        sources.latest_partition(df, ["year"], within="year > 3000")
    with pytest.raises(ValueError):
        sources.latest_partition(df, ["year", "month"], value=[2024])


def test_latest_from_the_catalog(spark):
    table = "dated_table"
    path = scratch_dir(spark, table)
    rows = [("2024", m, m) for m in ("9", "10", "2")]
    (spark.createDataFrame(rows, "year string, month string, v string")
     .write.partitionBy("year", "month").option("path", path).saveAsTable(table))
    parts = sources.table_partitions(spark, table, {"year": "int", "month": "int"})
    assert multiset(parts.collect()) == multiset([(2024, 9), (2024, 10), (2024, 2)])
    got = sources.latest_partition(spark.table(table), ["year", "month"], partitions=parts)
    assert [r.v for r in got.collect()] == ["10"]
    spark.sql(f"DROP TABLE {table}")


def test_listed_partitions_are_values_not_paths(spark):
    table = "odd_dates"
    path = scratch_dir(spark, table)
    values = ["2024-01-05 00:00:00", "2024-01-04 00:00:00", None, "a+b %41=/c"]
    (spark.createDataFrame([(v, v) for v in values], "load_date string, v string")
     .write.partitionBy("load_date").option("path", path).saveAsTable(table))
    listed = sources.table_partitions(spark, table, {"load_date": "string"})
    assert multiset(listed.collect()) == multiset([(v,) for v in values])
    got = sources.latest_partition(spark.table(table), ["load_date"], "load_date like '2%'",
                                   partitions=listed)
    assert [r.v for r in got.collect()] == ["2024-01-05 00:00:00"]
    with pytest.raises(LookupError, match="no rows"):
        sources.latest_partition(spark.table(table).where("v is null"), ["load_date"],
                                 partitions=listed)
    spark.sql(f"DROP TABLE {table}")


def test_next_run_number_reads_the_day_only(spark, dated):
    df = spark.read.parquet(dated).withColumn("run_no", F.col("run_no").cast("string"))
    next_run = sources.next_run_number(df, "2024-10-02")
    plan = next_run._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{c}#" in filters for c in ("year", "month", "day"))
    assert next_run.collect() == [("13",)]


def test_next_run_number_from_a_listing_with_odd_runs(spark):
    table = "runs"
    rows = [("2024", "01", "05", r, 1) for r in ("2", "x", "")] + [("2024", "1", "6", "9", 1)]
    (spark.createDataFrame(rows, "year string, month string, day string, run_no string, v int")
     .write.partitionBy("year", "month", "day", "run_no")
     .option("path", scratch_dir(spark, table)).saveAsTable(table))
    keys = {c: "string" for c in ("year", "month", "day", "run_no")}
    for df in (spark.table(table), sources.table_partitions(spark, table, keys)):
        assert sources.next_run_number(df, "2024-01-05").collect() == [("03",)]
        assert sources.next_run_number(df, "2024-01-07").collect() == [("01",)]
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("runs,day,want", [
    ([1, 2], "2024-01-05", "03"), ([9], "2024-01-05", "10"), ([99], "2024-01-05", "100"),
    ([7], "2024-01-06", "01"), ([], "2024-01-05", "01")])
def test_next_run_number(spark, runs, day, want):
    df = spark.createDataFrame([("2024", "01", "05", str(r)) for r in runs],
                               "year string, month string, day string, run_no string")
    assert [tuple(r) for r in sources.next_run_number(df, day).collect()] == [(want,)]


def test_counts(spark):
    df, seen = sources.observed_rows(spark.range(10))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 10}
    assert sources.count_rows(spark.range(10)).collect() == [(10,)]


# ---- Sinks ------------------------------------------------------------------------------

AWKWARD = ["", "a,b", 'q"q', "back\\slash", " blank ", "\\N-not", "é●", "l\nm", "c\rd", "e\r\nf",
           "\n", "\\", "\\n", '"', 'a\n"b",c']


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_round_trip_keeps_nulls_blanks_and_zeros(spark, tmp_path, fmt):
    rows = [(u, u, u, None, None, u, None, 5, "upc", "exact_match", "pets") for u in AWKWARD]
    df = stamp_load_date(spark.createDataFrame(rows, PAIR), "2024-01-05")
    path = str(tmp_path / "w")
    sources.write_warehouse(df, path, fmt)
    got = sources.read_warehouse(spark, path, fmt)
    assert got.schema == WAREHOUSE
    assert multiset(got.collect()) == multiset(df.collect())
    assert partition_dirs(path) == ["year=2024/month=01/day=05"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_table_keeps_nulls_and_blanks(spark, fmt):
    rows = [(u, u, u, None, None, u, None, 5, "upc", "exact_match", "pets") for u in AWKWARD]
    df = stamp_load_date(spark.createDataFrame(rows, PAIR), "2024-01-05")
    table = f"kept_{fmt}"
    path = scratch_dir(spark, table)
    for _ in range(2):
        sources.write_warehouse(df, table, fmt, path=path)
    assert multiset(spark.table(table).select(*WAREHOUSE.names).collect()) == multiset(df.collect())
    spark.sql(f"DROP TABLE {table}")


def test_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "w")
    for uuids, day in (("ab", "2024-01-05"), ("c", "2024-01-06"), ("d", "2024-01-05")):
        sources.write_warehouse(stamp_load_date(pair(spark, *uuids), day), path)
    got = sources.read_warehouse(spark, path).select("uuid_a", "day").collect()
    assert multiset(got) == multiset([("d", "05"), ("c", "06")])
    sources.write_warehouse(stamp_load_date(pair(spark, "e"), "2024-01-05"), path, mode="append")
    assert sources.read_warehouse(spark, path).count() == 3


def test_table_write_registers_partitions_and_reruns(spark):
    table = "match_warehouse"
    path = scratch_dir(spark, table)
    for uuids, day in (("ab", "2024-01-05"), ("c", "2024-01-06"), ("d", "2024-01-05")):
        sources.write_warehouse(stamp_load_date(pair(spark, *uuids), day), table, path=path)
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert sorted(parts) == ["year=2024/month=01/day=05", "year=2024/month=01/day=06"]
    got = spark.table(table).select("uuid_a", "day").collect()
    assert multiset(got) == multiset([("d", "05"), ("c", "06")])
    spark.sql(f"DROP TABLE {table}")


def test_write_split(spark, tmp_path):
    df = stamp_load_date(pair(spark, "a", "b").unionByName(pair(spark, "c", kind="not_a_match"))
                         .unionByName(pair(spark, "d", kind="similar_match")), "2024-01-05")
    targets = {("exact_match", "similar_match"): str(tmp_path / "m"),
               ("not_a_match",): str(tmp_path / "r")}
    sources.write_split(df, targets, stage=str(tmp_path / "stage"))
    got = [sorted(r.uuid_a for r in sources.read_warehouse(spark, t).collect())
           for t in targets.values()]
    assert got == [["a", "b", "d"], ["c"]]


@pytest.fixture
def odd_types(spark):
    rows = pair(spark, "a").unionByName(pair(spark, "b", kind="odd")).unionByName(
        pair(spark, "c", kind=None))
    return stamp_load_date(rows, "2024-01-05")


def test_split_refuses_types_of_no_target(spark, tmp_path, odd_types, monkeypatch):
    staged = []
    monkeypatch.setattr(sources.sinks, "scratch_dir",
                        lambda *_: staged.append(str(tmp_path / "own")) or staged[-1])
    with pytest.raises(ValueError, match="2 rows"):
        sources.write_split(odd_types, {("exact_match",): str(tmp_path / "m")})
    assert staged and not os.path.exists(staged[0]) and not (tmp_path / "m").exists()


def test_split_writes_the_rest(spark, tmp_path, odd_types, monkeypatch):
    monkeypatch.setattr(sources.sinks, "scratch_dir", lambda *_: str(tmp_path / "own"))
    sources.write_split(odd_types, {("exact_match",): str(tmp_path / "m")},
                        rest=str(tmp_path / "r"))
    got = [sorted((r.uuid_a, r.type) for r in sources.read_warehouse(spark, str(tmp_path / t))
                  .collect()) for t in "mr"]
    assert got == [[("a", "exact_match")], [("b", "odd"), ("c", None)]]
    assert not (tmp_path / "own").exists()


def test_split_of_one_day_does_not_shuffle(spark, tmp_path, odd_types, monkeypatch):
    plans = []
    write = sources.sinks.write_warehouse
    monkeypatch.setattr(sources.sinks, "write_warehouse", lambda df, *args, **options: (
        plans.append((df, options)) or write(df, *args, **options)))
    sources.write_split(odd_types, {("exact_match",): str(tmp_path / "m")},
                        rest=str(tmp_path / "r"))
    for df, options in plans:
        assert not options["spread"]
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_spread_writes_few_files_per_date(spark, conf, tmp_path):
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB"})
    days = [stamp_load_date(pair(spark, *"abcdefgh"), f"2024-01-0{d}") for d in range(1, 6)]
    df = days[0]
    for other in days[1:]:
        df = df.unionByName(other)
    path = str(tmp_path / "w")
    sources.write_warehouse(df.repartition(8), path, spread=True)
    files = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    assert len(files) == 5


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = (scratch_dir(spark, "x") for _ in range(2))
    assert one != two and one.startswith(base.rstrip("/") + "/")


def test_scratch_without_the_setting():
    """On a stock Spark, whose running sessions may not change the setting."""
    code = """
from pyspark.sql import SparkSession
from pairloom.scratch import remove, scratch_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
assert one != two and one.split("/x-")[0] == two.split("/x-")[0]
spark.range(3).write.parquet(one)
assert spark.read.parquet(one).count() == 3
remove(spark, one)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": os.path.join(root, "tests"), "PYTHONPATH": root}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=120,
                   capture_output=True)
