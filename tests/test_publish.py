"""Publication of a day, its gates, layouts for lookups, and listings by partition."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairloom import sources
from pairloom.schema import WAREHOUSE
from pairloom.scratch import scratch_dir
from pairloom.sources import Limit, LimitBreached, publish, table_partitions

TABLE = "published_t"


@pytest.fixture
def rows(spark):
    """Warehouse rows: of 100, 10 without a key, 5 without an id, 20 rejects."""
    i = F.col("id")
    uuid = F.concat(F.when(i < 5, "-").otherwise(i.cast("string")), F.lit("<>"),
                    F.when(i < 5, "na").otherwise("S"), F.lit("<>a<>a"))
    columns = {f.name: F.lit("x").cast(f.dataType) for f in WAREHOUSE.fields}
    columns["match_timestamp"] = i
    columns |= {"uuid_a": uuid, "uuid_b": F.lit("1<>S<>b<>b"),
                "sku_uuid_a": F.when(i % 10 != 3, F.format_string("k%03d", i)),
                "type": F.when(i % 5 == 0, "not_a_match").when(i % 5 == 1, None).otherwise(
                    "exact_match")}
    return spark.range(100).select([c.alias(n) for n, c in columns.items()])


@pytest.fixture
def table(spark):
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")
    yield TABLE
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")


def days(spark, table):
    return {(r.year, r.month, r.day): r["count"]
            for r in spark.table(table).groupBy("year", "month", "day").count().collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_days_are_replaced_one_by_one(spark, rows, table, fmt):
    sources.publish_day(rows, table, "2024-01-05", fmt=fmt)
    sources.publish_day(rows.limit(7), table, "2024-02-10", fmt=fmt)
    assert days(spark, table) == {("2024", "01", "05"): 100, ("2024", "02", "10"): 7}
    sources.publish_day(rows.limit(9), table, "2024-01-05", fmt=fmt)
    assert days(spark, table) == {("2024", "01", "05"): 9, ("2024", "02", "10"): 7}
    got = spark.table(table).where("month = '01'").drop("year", "month", "day")
    assert got.exceptAll(rows.limit(9).select(*got.columns)).isEmpty()
    assert "month=02" in str(spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_failure_between_write_and_publication(spark, rows, table, monkeypatch):
    sources.publish_day(rows, table, "2024-01-05")
    seen = []

    def fail(spark, name, parts, folder):
        seen.append(spark.read.parquet(folder).count())
        raise OSError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(publish, "_show", fail)
        with pytest.raises(OSError, match="lost"):
            sources.publish_day(rows.limit(3), table, "2024-01-05")
        with pytest.raises(OSError, match="lost"):
            sources.publish_day(rows.limit(3), table, "2024-01-06")
    assert seen == [3, 3]
    assert days(spark, table) == {("2024", "01", "05"): 100}
    sources.publish_day(rows.limit(3), table, "2024-01-05")
    assert days(spark, table) == {("2024", "01", "05"): 3}


def test_failing_write_leaves_the_old_day(spark, rows, table):
    sources.publish_day(rows, table, "2024-01-05")
    broken = rows.withColumn("score", F.raise_error(F.lit("torn")).cast("string"))
    with pytest.raises(Exception, match="torn"):
        sources.publish_day(broken, table, "2024-01-05")
    assert days(spark, table) == {("2024", "01", "05"): 100}


def test_a_reader_keeps_its_version(spark, rows, table):
    sources.publish_day(rows, table, "2024-01-05")
    reader = spark.table(table).where("day = '05'")
    reader._jdf.queryExecution().executedPlan()
    sources.publish_day(rows.limit(2), table, "2024-01-05")
    assert len(reader.collect()) == 100
    assert sources.drop_old_versions(spark, table, "2024-01-05") == 1
    assert sources.drop_old_versions(spark, table, "2024-01-05") == 0
    assert sources.drop_old_versions(spark, table, "2031-01-05") == 0
    assert days(spark, table) == {("2024", "01", "05"): 2}


def test_metrics_and_limits(spark, rows, table):
    want = {"row_count": 100, "null_keys": 10, "bare_keys": 5, "type_exact_match": 60,
            "type_similar_match": 0, "type_not_a_match": 20, "type_other": 20}
    assert sources.count_metrics(rows).head().asDict() == want
    fine = [Limit("row_count", least=100, most=100), Limit("null_keys", most=0.1, share=True)]
    assert sources.publish_day(rows, table, "2024-01-05", limits=fine) == want
    broken = [Limit("null_keys", most=0.09, share=True), Limit("bare_keys", most=4),
              Limit("type_similar_match", least=1), *fine]
    with pytest.raises(LimitBreached) as said:
        sources.publish_day(rows.where("true"), table, "2024-01-05", limits=broken)
    assert str(said.value) == ("null_keys 0.1 is above 0.09; bare_keys 5 is above 4; "
                               "type_similar_match 0 is below 1")
    assert days(spark, table) == {("2024", "01", "05"): 100}
    # What was not published is gone.
    assert sources.drop_old_versions(spark, table, "2024-01-05") == 0


def test_no_rows(spark, rows, table):
    none = rows.where("false")
    assert sources.publish_day(none, table, "2024-01-05")["row_count"] == 0
    with pytest.raises(LimitBreached):
        sources.publish_day(none, table, "2024-01-05", limits=[Limit("row_count", least=1)])
    sources.publish_day(none, table, "2024-01-05", limits=[Limit("null_keys", most=0, share=True)])
    assert spark.table(table).isEmpty()


def groups(folder, column, value):
    """Row groups of a folder, and those whose range holds the value."""
    found = []
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        found += [s.min <= value <= s.max for s in stats if s is not None and s.has_min_max]
    return len(found), sum(found)


def test_lookup_reads_a_fraction_of_the_row_groups(spark, conf, tmp_path):
    conf({"parquet.block.size": str(64 << 10), "spark.sql.adaptive.enabled": "false",
          "parquet.page.size": str(8 << 10)})
    i = F.col("id")
    rows = spark.range(200_000).select(
        F.md5(i.cast("string")).alias("sku_uuid_a"), F.sha1(i.cast("string")).alias("payload"),
        F.lit("2024").alias("year"), F.lit("01").alias("month"),
        F.when(i % 2 == 0, "05").otherwise("06").alias("day"))
    key = spark.range(4, 5).select(F.md5(i.cast("string")).alias("k")).head().k
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    sources.write_warehouse(rows, plain)
    sources.write_warehouse(sources.order_for_lookup(rows), ordered)
    all_groups, hit = groups(plain, "sku_uuid_a", key)
    assert hit > all_groups / 2
    all_groups, hit = groups(ordered, "sku_uuid_a", key)
    assert all_groups > 50 and hit <= 3
    assert spark.read.parquet(ordered).count() == 200_000


def test_lookup_layout_splits_a_hot_key(spark, conf):
    conf({"spark.sql.adaptive.enabled": "false"})
    rows = spark.range(40_000).select(F.lit("hot").alias("sku_uuid_a"), "id")
    laid = sources.order_for_lookup(rows, within=())
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 15_000


def test_published_for_lookup(spark, rows, table):
    sources.publish_day(rows, table, "2024-01-05", lookup=["sku_uuid_a"])
    assert days(spark, table) == {("2024", "01", "05"): 100}
    got = spark.table(table).drop("year", "month", "day")
    assert got.exceptAll(rows.select(*got.columns)).isEmpty()


def test_catalog_lists_only_the_partitions_asked_for(spark, tmp_path, monkeypatch):
    name = "two_keys_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(120).select(
        F.when(F.col("id") % 2 == 0, "it's").otherwise("b\\c=d").alias("domain"),
        (F.col("id") % 30).cast("string").alias("run"), "id")
    rows.write.partitionBy("domain", "run").option("path", str(tmp_path)).saveAsTable(name)
    keys = {"domain": "string", "run": "int"}
    assert table_partitions(spark, name, keys).count() == 30
    for domain, newest in (("it's", 28), ("b\\c=d", 29)):
        listed = table_partitions(spark, name, keys, within={"domain": domain})
        assert {r.domain for r in listed.collect()} == {domain} and listed.count() == 15
        plan = listed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("domain=") <= 15
        got = sources.latest_partition(spark.table(name), ["run"], F.col("domain") == domain,
                                       partitions=listed)
        assert {(r.domain, r.run) for r in got.collect()} == {(domain, str(newest))}
    assert table_partitions(spark, name, keys, {"domain": "none"}).isEmpty()
    assert table_partitions(spark, name, keys, {"domain": "it's", "run": "4"}).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_scratch_of_a_missing_day(spark):
    folder = scratch_dir(spark, "none")
    sources.replace_day(spark.range(0), folder, "2024-01-05", 0)
