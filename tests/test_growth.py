"""What keeps time and disk in proportion to the input: no copy is wider, sorted or computed twice."""

import datetime
import glob

import pytest
from oracle import connect, difference
from pyspark.sql import DataFrameWriter, functions as F

from checks import fixtures, queries
from checks.oracles import ORACLES
from pairloom import functions as ids
from pairloom import plans, sources
from pairloom.schema import LABELLED, LOAD_DATE, REVIEW, WAREHOUSE
from pairloom.settings import METHOD_LIMIT, compiled_session

LIMIT = "spark.sql.codegen.hugeMethodLimit"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def fresh(monkeypatch):
    """No copies of earlier queries."""
    monkeypatch.setattr(queries, "_COPIES", {})


def frame(spark, schema, rows, **values):
    columns = {f.name: F.lit("x").cast(f.dataType) for f in schema.fields} | values
    return spark.range(rows).select([c.alias(n) for n, c in columns.items()])


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_are_those_of_a_split(spark):
    texts = ["a<>b<>c<>d", "a<>b<>c<>d<>e", "a<>b", "a", "", "<>", "<><><>", "<<>>", "a<>", None,
             "é<>ß<>日本<>x", "a<b>c<>d", "<>b<><>d"]
    df = spark.createDataFrame([(t,) for t in texts], "u string").repartition(2)
    parts = df.select("u", *[F.get(ids.uuid_parts("u"), F.lit(i)).alias(f"p{i}") for i in range(4)])
    for u, *found in parts.collect():
        whole = [] if u is None else u.split("<>")
        assert found == [*whole, None, None, None, None][:4], u
    assert "split(" not in optimized(df.select(ids.join_key("u"), ids.store_key("u")))


def test_stages_are_compiled_in_a_session_of_their_own(spark, sf_dir, conf):
    conf({"spark.sql.shuffle.partitions": "7"})
    own = spark.conf.get(LIMIT)
    session = compiled_session(spark)
    assert int(session.conf.get(LIMIT)) == METHOD_LIMIT and compiled_session(session) is session
    assert session.conf.get("spark.sql.shuffle.partitions") == "7"
    for name in ("warehouse_from_sources", "build_warehouse", "matches_and_rejects",
                 "combine_matches", "warehouse_pruned"):
        got = queries.QUERIES[name](spark, sf_dir)
        assert int(got.sparkSession.conf.get(LIMIT)) == METHOD_LIMIT, name
    assert spark.conf.get(LIMIT) == own


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_is_packed(spark, tmp_path, fmt):
    rows = frame(spark, WAREHOUSE, 50, uuid_a=F.col("id").cast("string"), year=F.lit("2024"),
                 month=F.lit("01"), day=F.lit("05"), match_timestamp=F.col("id"))
    sources.write_warehouse(rows, f"{tmp_path}/t", fmt)
    files = glob.glob(f"{tmp_path}/t/**/part-*", recursive=True)
    assert files and all(f.endswith(f".{fmt}.gz") for f in files)
    back = sources.read_warehouse(spark, f"{tmp_path}/t", fmt)
    assert sorted(back.collect()) == sorted(rows.select(*WAREHOUSE.names).collect())


def test_review_files_are_packed(spark, sf_dir, fresh):
    path = queries._review_files(spark, sf_dir)
    files = glob.glob(f"{path}/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)


def test_the_date_of_a_warehouse_is_a_constant(spark):
    labelled = frame(spark, LABELLED, 3, type=F.lit("exact_match"), priority=F.lit(0),
                     match_timestamp=F.col("id"))
    plan = optimized(plans.warehouse_from_labelled(labelled, "2024-01-05"))
    assert "2024 AS year" in plan.splitlines()[0]


def test_staged_kinds_are_not_sorted(spark, tmp_path, monkeypatch):
    seen, parquet = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        seen.append(int(self._spark.conf.get(WRITERS)))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    own = spark.conf.get(WRITERS)
    bare = F.when(F.col("id") % 3 == 0, "-<>na<>s<>s").otherwise("1<>S<>s<>s")
    labelled = frame(spark, LABELLED, 9, uuid_a=bare, uuid_b=F.lit("2<>T<>t<>t"),
                     match_timestamp=F.col("id"), priority=F.lit(0))
    whole, without, count = plans.split_bare(labelled)
    assert (whole.count(), without.count(), count) == (6, 3, 3)
    (tmp_path / "x.json").write_text('{"score": "1"}\n{"score": "2", "workf\n')
    good, bad, _ = sources.stage_json(spark, str(tmp_path / "x.json"), REVIEW)
    assert (good.count(), bad.count()) == (1, 1)
    rows = frame(spark, WAREHOUSE, 9, match_timestamp=F.col("id"),
                 type=F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    sources.write_split(rows, {("a",): f"{tmp_path}/a"}, rest=f"{tmp_path}/b")
    assert sources.read_warehouse(spark, f"{tmp_path}/a").count() == 5
    assert len(seen) == 3 and min(seen) > 1 and spark.conf.get(WRITERS) == own


def test_more_partitions_than_writers(spark, tmp_path):
    with sources.few_partitions(spark, 2):
        spark.range(40).withColumn("p", F.col("id") % 7).coalesce(1).write.partitionBy(
            "p").parquet(f"{tmp_path}/t")
    got = spark.read.parquet(f"{tmp_path}/t").select("id", "p").collect()
    assert sorted((r.id, r.p) for r in got) == [(i, i % 7) for i in range(40)]


def test_published_rows_are_computed_once(spark, sf_dir, fresh, monkeypatch):
    read, publish = [], sources.publish_day

    def spy(df, *args, **kwargs):
        read.append(df.inputFiles())
        return publish(df, *args, **kwargs)

    monkeypatch.setattr(sources, "publish_day", spy)
    queries.QUERIES["publish_day"](spark, sf_dir)
    assert len(read) == 3 and not any("lineitem" in f for files in read for f in files)


def test_pairs_are_stored_without_a_shuffle(spark, sf_dir, fresh, monkeypatch):
    spread = []
    monkeypatch.setattr(sources, "rebalance", lambda df, *_: spread.append(df) or df)
    monkeypatch.setattr(sources.sinks, "rebalance", lambda df, *_: spread.append(df) or df)
    table = queries._pairs_table(spark, sf_dir)
    assert not spread and spark.table(table).count() == queries._pairs(spark, sf_dir).count()


# ---- Large order keys -------------------------------------------------------------------

DATE = "CAST(1600000000 + l_orderkey * 60 AS INT)"
LAST_KEY = (2**31 - 1 - 1600000000) // 60


@pytest.fixture(scope="module")
def large_keys(spark, tmp_path_factory):
    """A folder with a `lineitem` of keys on both sides of the last one whose date is an INT."""
    folder = tmp_path_factory.mktemp("large_keys")
    key = F.when(F.col("id") % 3 == 0, F.col("id") * 90_001).otherwise(LAST_KEY - 150 + F.col("id"))
    (spark.range(0, 600, 1, 1).select(
        key.alias("l_orderkey"), (F.col("id") % 70).alias("l_partkey"),
        (F.col("id") % 24).alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") % 11 / 100).alias("l_discount"), (F.col("id") % 9 / 100).alias("l_tax"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.when(F.col("id") % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.lit(datetime.datetime(1996, 3, 4)).alias("l_shipdate"))
     .write.parquet(f"{folder}/spark"))
    (part,) = glob.glob(f"{folder}/spark/part-*.parquet")
    (folder / "lineitem.parquet").write_bytes(open(part, "rb").read())
    return str(folder)


def test_dates_beyond_their_type_are_null(spark, large_keys):
    rows = spark.read.parquet(f"{large_keys}/lineitem.parquet")
    dates = [1600000000 + r.l_orderkey * 60 for r in rows.collect()]
    found = [r.match_date for r in fixtures.library(spark, large_keys).collect()]
    assert sorted(f for f in found if f is not None) == sorted(d for d in dates if d < 2**31)
    assert 0 < found.count(None) == sum(d >= 2**31 for d in dates)


@pytest.mark.parametrize("name", ["publish_day", "write_split", "write_split_rest",
                                  "warehouse_without_bare", "write_warehouse_csv"])
def test_large_order_keys(spark, large_keys, fresh, name):
    sql = ORACLES[name]
    assert DATE in sql
    got = queries.QUERIES[name](spark, large_keys)
    assert difference(connect(large_keys), sql.replace(DATE, f"TRY_{DATE}"), got) is None


# ---- Shuffles, copies and code ----------------------------------------------------------

def test_a_filter_on_bare_pairs_is_compiled(spark, sf_dir, conf):
    conf({"spark.sql.codegen.fallback": "false"})
    assert not queries.QUERIES["warehouse_without_bare"](spark, sf_dir).isEmpty()


def test_ids_are_those_of_the_parts(spark):
    uuids = ["-<>na<>s<>s", "000<>NULL<>s<>s", "-<>A<>s<>s", "1<>-<>s<>s", "01<>-<>s<>s", "A<>-<>s<>s",
             "-", "-<>", "<>", "", "-<>na", "-<>na<>s<>s<>x", None]
    df = spark.createDataFrame([(u,) for u in uuids], "u string")
    placeholders = {"", "-", "0", "1", "na", "null"}

    def bare(uuid):
        if uuid is None:
            return None
        upc, sku = [*uuid.lower().split("<>"), None][:2]
        if upc.lstrip("0") not in placeholders:
            return False
        return None if sku is None else sku in placeholders
    assert [r[0] for r in df.select(ids.lacks_ids("u")).collect()] == [bare(u) for u in uuids]


def test_plain_scans(spark, tmp_path):
    spark.range(9).withColumn("t", F.lit("x")).write.parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    plain = sources.scans.is_plain_scan
    assert plain(read) and plain(read.select("t", F.col("id").alias("n"), F.lit(1)).drop("t"))
    for other in (read.where("id > 1"), read.select(F.upper("t")), read.select(F.rand()),
                  read.distinct(), read.union(read), spark.range(3), read.limit(2)):
        assert not plain(other)


@pytest.mark.parametrize("stored", [False, True])
def test_rows_of_files_are_not_stored_for_a_lookup(spark, tmp_path, monkeypatch, stored):
    staged, scratch = [], sources.sinks.scratch_dir
    monkeypatch.setattr(sources.sinks, "scratch_dir",
                        lambda spark, name: staged.append(name) or scratch(spark, name))
    table = f"looked_up_{int(stored)}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = frame(spark, WAREHOUSE, 500, match_timestamp=F.col("id"),
                 sku_uuid_a=F.format_string("%03d", F.col("id") * 7 % 500))
    rows.write.parquet(f"{tmp_path}/rows")
    read = spark.read.schema(WAREHOUSE).parquet(f"{tmp_path}/rows")
    if stored:
        read = read.where("match_timestamp >= 0")
    try:
        counted = sources.publish_day(read, table, "2024-01-05", path=f"{tmp_path}/t",
                                      lookup=["sku_uuid_a", "day"])
        got = spark.table(table).collect()
    finally:
        spark.sql(f"DROP TABLE {table}")
    assert staged == ["lookup"] * stored and counted["row_count"] == 500
    assert sorted(r.match_timestamp for r in got) == [*range(500)]
    assert {tuple(r[c] for c in LOAD_DATE) for r in got} == {("2024", "01", "05")}
    files = glob.glob(f"{tmp_path}/t/_versions/**/part-*", recursive=True)
    for file in files:
        keys = [r.sku_uuid_a for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys) and file.endswith(".zstd.parquet")


def test_targets_of_a_split_are_not_sorted(spark, tmp_path, monkeypatch):
    seen, write = [], sources.sinks.write_warehouse

    def spy(df, *args, **kwargs):
        seen.append(int(df.sparkSession.conf.get(WRITERS)))
        return write(df, *args, **kwargs)

    monkeypatch.setattr(sources.sinks, "write_warehouse", spy)
    own = spark.conf.get(WRITERS)
    rows = frame(spark, WAREHOUSE, 90, match_timestamp=F.col("id"),
                 day=F.format_string("%02d", F.col("id") % 9 + 1),
                 type=F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    sources.write_split(rows, {("a",): f"{tmp_path}/a"}, rest=f"{tmp_path}/b")
    assert len(seen) == 2 and min(seen) > 1 and spark.conf.get(WRITERS) == own
    for i, target in enumerate("ab"):
        got = sources.read_warehouse(spark, f"{tmp_path}/{target}").collect()
        assert sorted((r.match_timestamp, r.day) for r in got) == [
            (n, f"{n % 9 + 1:02d}") for n in range(i, 90, 2)]
        assert glob.glob(f"{tmp_path}/{target}/*/*/*/*.zstd.parquet")
