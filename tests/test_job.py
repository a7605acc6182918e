"""The whole job, from catalog tables and JSON folders to a partitioned table."""

import pytest
from pyspark.sql import functions as F

from pairloom import plans
from pairloom.scratch import remove, scratch_dir
from pairloom.settings import planned_bytes, settings_for, sized_for
from pairloom.sources import Limit, LimitBreached, read_warehouse


@pytest.fixture
def tables(spark, warehouse_inputs):
    """The sources as tables; the library also has an older load date, and two feeds a toy domain."""
    made = []

    def table(name, df, *partitions):
        df.write.partitionBy(*partitions).option("path", scratch_dir(spark, name)).saveAsTable(name)
        made.append(name)
        return name
    library = warehouse_inputs["library"]
    dated = (library.withColumn("load_date", F.lit("2024-01-04"))
             .unionByName(library.where("false").withColumn("load_date", F.lit("2024-01-05"))))
    older = library.withColumns({"company_code": F.lit("chewy"), "load_date": F.lit("2023-12-31")})
    folder = scratch_dir(spark, "json")
    *review_frames, last = warehouse_inputs["reviews"]
    last.write.json(f"{folder}/sub")
    yield {
        "library": table("lib_t", dated.unionByName(older), "load_date"),
        "review_tables": [table(f"rev_{i}", r) for i, r in enumerate(review_frames)],
        "review_folders": [folder],
        "feeds": {n: table(f"feed_{n}", f, "domain")
                  for n, f in warehouse_inputs["feeds"].items()},
    }
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def test_job_is_sized_by_its_input(spark, tables, monkeypatch):
    seen = []
    write = plans.job.write_warehouse

    def spy(rows, *args):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *args)
    monkeypatch.setattr(plans.job, "write_warehouse", spy)
    names = settings_for(1)
    before = {n: spark.conf.get(n, None) for n in names}
    for given, parts in ((230 * (128 << 20), 230), (None, 200)):
        plans.load_warehouse(spark, "pets", "2024-01-05", target=scratch_dir(spark, "sized"),
                             input_bytes=given, **tables)
        assert f", {parts}), ENSURE_REQUIREMENTS" in seen.pop()
    assert {n: spark.conf.get(n, None) for n in names} == before


def test_job_fails_without_a_library(spark, tables):
    empty = "lib_empty"
    path = scratch_dir(spark, empty)
    spark.table(tables["library"]).where("load_date = '2024-01-04'").write.partitionBy(
        "load_date").option("path", path).saveAsTable(empty)
    remove(spark, f"{path}/load_date=2024-01-04")
    spark.catalog.refreshTable(empty)
    target = scratch_dir(spark, "unwritten")
    with pytest.raises(LookupError):
        plans.load_warehouse(spark, "pets", "2024-01-05", target=target,
                             **{**tables, "library": empty})
    spark.sql(f"DROP TABLE {empty}")


def test_job_options_and_quarantine(spark, tables, warehouse_inputs):
    inputs = list(warehouse_inputs.values())
    options = {"domains": ["pets", "toys"], "drop_half_null": True, "dropped_workflows": ["none"]}
    target, bare = scratch_dir(spark, "w"), scratch_dir(spark, "bare")
    plans.load_warehouse(spark, "grocery", "2024-01-05", target=target, quarantine=bare, **options,
                         **tables)
    want = plans.warehouse_from_sources(*inputs, "2024-01-05", drop_bare=True, **options)
    got = read_warehouse(spark, target)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    left = plans.bare_pairs(*inputs, **options)
    held = spark.read.parquet(bare).select(*left.columns)
    assert held.count() == left.count() > 0 and held.exceptAll(left).isEmpty()


@pytest.mark.parametrize("domain,prefer", [("pets", "sku"), ("grocery", "upc")])
def test_job_writes_what_the_flow_builds(spark, tables, warehouse_inputs, domain, prefer):
    want = plans.warehouse_from_sources(*warehouse_inputs.values(), "2024-01-05", prefer=prefer)
    target = f"warehouse_{domain}"
    for _ in range(2):
        count = plans.load_warehouse(spark, domain, "2024-01-05", target=target, **tables)
    got = spark.table(target)
    assert count == got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty()
    spark.sql(f"DROP TABLE {target}")


def test_quarantine_keeps_each_day_and_scans_sources_once(spark, tables, warehouse_inputs,
                                                          monkeypatch):
    plans_seen = []
    apart = plans.job.split_bare

    def spy(labelled):
        plans_seen.append(labelled._jdf.queryExecution().executedPlan().toString())
        out = apart(labelled)
        plans_seen.append(out[0]._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(plans.job, "split_bare", spy)
    target, bare = "warehouse_two_days", scratch_dir(spark, "bare")
    for day in ("2024-01-05", "2024-01-06", "2024-01-06"):
        plans.load_warehouse(spark, "grocery", day, target=target, quarantine=bare, **tables)
    left = plans.bare_pairs(*warehouse_inputs.values())
    held = spark.read.option("basePath", bare).parquet(bare)
    assert {(r.year, r.month, r.day): r["count"] for r in held.groupBy(
        "year", "month", "day").count().collect()} == {
            (2024, 1, d): left.count() for d in (5, 6)}
    one = held.where("day = 6").select(*left.columns)
    assert one.exceptAll(left).isEmpty()
    want = plans.warehouse_from_sources(*warehouse_inputs.values(), "2024-01-06", drop_bare=True)
    got = spark.table(target).where("day = '06'").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert spark.table(target).count() == 2 * want.count()
    # Eight sources in the one pass, and only its stored rows afterwards.
    assert plans_seen[0].count("FileScan") == 8 and plans_seen[1].count("FileScan") == 1
    spark.sql(f"DROP TABLE {target}")


def test_quarantine_of_a_day_without_bare_pairs_is_emptied(spark, tables, monkeypatch):
    target, bare = scratch_dir(spark, "w"), scratch_dir(spark, "bare")
    for day in ("2024-01-05", "2024-01-06"):
        plans.load_warehouse(spark, "pets", day, target=target, quarantine=bare, **tables)
    monkeypatch.setattr(plans.job, "is_bare", lambda: F.lit(False))
    plans.load_warehouse(spark, "pets", "2024-01-06", target=target, quarantine=bare, **tables)
    assert [r.day for r in spark.read.parquet(bare).select("day").distinct().collect()] == [5]


def test_bad_json_lines_go_aside(spark, tables, warehouse_inputs):
    folder, lines = tables["review_folders"][0], scratch_dir(spark, "lines")
    bad = ['{"base_upc": "1", ', "no json"]
    spark.createDataFrame([(b,) for b in bad], "line string").coalesce(1).write.mode(
        "append").text(f"{folder}/more")
    target = scratch_dir(spark, "with_bad")
    with pytest.raises(Exception, match="(?i)malformed"):
        plans.load_warehouse(spark, "grocery", "2024-01-05", target=target, **tables)
    with pytest.raises(LimitBreached, match="bad_lines 2 is above 1"):
        plans.load_warehouse(spark, "grocery", "2024-01-05", target=target, bad_lines=lines,
                             bad_line_limit=Limit("bad_lines", most=1), **tables)
    for day in ("2024-01-05", "2024-01-06"):
        plans.load_warehouse(spark, "grocery", day, target=target, bad_lines=lines,
                             bad_line_limit=Limit("bad_lines", most=2), **tables)
    assert sorted(map(tuple, spark.read.parquet(lines).collect())) == sorted(
        (b, 2024, 1, d) for b in bad for d in (5, 6))
    want = plans.warehouse_from_sources(*warehouse_inputs.values(), "2024-01-06")
    got = read_warehouse(spark, target).where("day = '06'")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("target", ["warehouse_limited", "folder"])
def test_broken_limit_publishes_nothing(spark, tables, target):
    if target == "folder":
        target = scratch_dir(spark, "limited")
    read = spark.table if "/" not in target else lambda t: read_warehouse(spark, t)
    count = plans.load_warehouse(spark, "pets", "2024-01-05", target=target,
                                 limits=[Limit("row_count", least=1)], **tables)
    with pytest.raises(LimitBreached, match="row_count .* is below"):
        plans.load_warehouse(spark, "grocery", "2024-01-05", target=target,
                             limits=[Limit("row_count", least=10 * count)], **tables)
    assert read(target).count() == count
    want = read(target).collect()
    assert sorted(map(str, want)) == sorted(map(str, read(target).collect()))
    if "/" not in target:
        spark.sql(f"DROP TABLE {target}")


def test_sources_of_unknown_size(spark, tables, warehouse_inputs):
    """Views on rows of the driver have no size; the job then runs as the session is set."""
    rows = warehouse_inputs["reviews"][0]
    spark.createDataFrame(rows.collect(), rows.schema).createOrReplaceTempView("rows_of_driver")
    assert planned_bytes(spark.table("rows_of_driver")) is None
    assert planned_bytes(rows, spark.table("rows_of_driver")) is None
    assert planned_bytes(spark.range(10)) == 80
    assert planned_bytes(spark.table(tables["library"])) > 0
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sized_for(spark, None):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    target = scratch_dir(spark, "unsized")
    count = plans.load_warehouse(spark, "pets", "2024-01-05", target=target,
                                 **{**tables, "review_tables": ["rows_of_driver",
                                                                *tables["review_tables"][1:]]})
    assert count == read_warehouse(spark, target).count() > 0
    spark.catalog.dropTempView("rows_of_driver")
