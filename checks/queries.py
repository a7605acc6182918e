"""One query per operator of the survey's inventory, each over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom import functions as ids
from pairloom import operators as op
from pairloom import plans, sources
from pairloom.rules import (
    DROPPED_COMPANY,
    DROPPED_WORKFLOWS,
    EXACT,
    EXACT_ANSWERS,
    GROCERY,
    OFFICE,
    PETS,
    PETS_MODELS,
    REJECT,
    REJECT_ANSWERS,
    SIMILAR,
    UNDECIDED_ANSWERS,
    VERIFIED_STATES,
)
from pairloom.schema import (
    DATED_LABELLED,
    FEED,
    PAIR,
    REVIEW,
    conform,
    resolve_types,
    union_conformed,
)
from pairloom.scratch import remove, scratch_dir
from pairloom.settings import compiled_session

from .fixtures import feeds, fixture, library, review_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOAD_DAY = "2024-01-05"
NEXT_DAY = "2024-01-06"
RUN_DAY = "1997-03-04"


def query(fn: Query) -> Query:
    """Register under the function's name, less a closing underscore."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def _pairs(spark, sf):
    return fixture(spark, sf, "fx_pairs")


def _reviews(spark, sf):
    return fixture(spark, sf, "fx_reviews")


def _snapshots(spark, sf):
    return fixture(spark, sf, "fx_snapshots")


def _filled(spark, sf):
    return op.fill_blank(library(spark, sf))


def _keyed_pairs(spark, sf):
    """Pair-feed rows with keys, stores and seconds, before any de-duplication."""
    pairs = op.add_keys(_pairs(spark, sf)).withColumn(
        "match_timestamp", ids.parts_to_epoch("day", "month", "year"))
    tagged = op.tag(pairs, match_source="upc", type=EXACT)
    return conform(op.rename_cols(tagged, {"domain": "segment"}), PAIR)


# ---- Written copies, one per session and input folder -----------------------------------

_COPIES: dict[tuple[str, str, str], str] = {}


def _copy(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _COPIES:
        path = scratch_dir(spark, name)
        write(path)
        _COPIES[key] = path
    return _COPIES[key]


def _pairs_table(spark: SparkSession, sf: str) -> str:
    """A catalog table of the pair feeds, partitioned by domain."""
    table = "fx_pairs_" + hashlib.sha256(sf.encode()).hexdigest()[:8]

    def write(path):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        # Each task writes a file per domain, of which there are five: nothing is shuffled.
        with sources.few_partitions(spark, 8):
            sources.write_warehouse(_pairs(spark, sf), table, mode="error", partitions=["domain"],
                                    path=path)
    _copy(spark, sf, table, write)
    return table


def _review_files(spark: SparkSession, sf: str) -> str:
    """JSON files of the reviews, in a folder per source."""
    return _copy(spark, sf, "fx_reviews_json", lambda path: op.drop_cols(
        _reviews(spark, sf).withColumn("source", F.col("feed")), "feed")
        .write.options(**sources.PACKED).partitionBy("source").json(path))


# ---- Sources ----------------------------------------------------------------------------

@query
def scan_partitioned(spark, sf):
    return sources.scan_partitioned(spark, _pairs_table(spark, sf), "domain = 'pets'")


@query
def scan_table(spark, sf):
    return sources.scan_table(spark, _pairs_table(spark, sf))


@query
def scan_json_dir(spark, sf):
    return sources.scan_json_dir(spark, _review_files(spark, sf), REVIEW)


@query
def scan_json_numbers(spark, sf):
    """Dates as whole numbers, decimals, powers of ten and text."""
    def write(path):
        for i, kind in enumerate(("bigint", "double", "decimal(20,1)", "string")):
            rows = _reviews(spark, sf).where(F.col("feed") == i)
            (rows.withColumn("match_date", F.col("match_date").cast(kind))
             .write.mode("append").options(**sources.PACKED).json(path))
    path = _copy(spark, sf, "fx_reviews_numbers", write)
    return sources.scan_json_dir(spark, path, REVIEW)


@query
def scan_small_files(spark, sf):
    packing = spark.newSession()
    sources.pack_small_files(packing)
    return sources.scan_json_dir(packing, _review_files(spark, sf), REVIEW)


@query
def resolve_types_(spark, sf):
    unread = _snapshots(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("order_text"),
        F.when(F.col("run_no") == 1, "n/a").otherwise(F.col("o_custkey").cast("string"))
        .alias("cust_text"), "run_no")
    return resolve_types(unread, {"order_text": "bigint", "cust_text": "int", "run_no": "string"})


@query
def latest_partition(spark, sf):
    return sources.latest_partition(_snapshots(spark, sf), ["load_date"])


@query
def latest_partition_listed(spark, sf):
    """From the catalog, of a table that also has a null date, and times that paths escape."""
    table = "fx_snapshots_" + hashlib.sha256(sf.encode()).hexdigest()[:8]
    when = F.concat(F.col("load_date"), F.lit(" 00:00:00"))

    def write(path):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        rows = _snapshots(spark, sf).withColumn("load_date", F.when(F.col("run_no") != 3, when))
        rows.write.partitionBy("load_date").option("path", path).saveAsTable(table)
    _copy(spark, sf, table, write)
    listed = sources.table_partitions(spark, table, {"load_date": "string"})
    return sources.latest_partition(spark.table(table), ["load_date"], partitions=listed)


@query
def latest_partition_by_parts(spark, sf):
    return sources.latest_partition(_snapshots(spark, sf), ["year", "month", "day"],
                                    within="run_no = 2")


@query
def latest_partition_and_run(spark, sf):
    return sources.latest_partition(_snapshots(spark, sf), ["year", "month", "day", "run_no"])


@query
def scan_in_list(spark, sf):
    return sources.scan_partitioned(spark, _pairs_table(spark, sf), "year = '1996'",
                                    in_={"domain": ["pets", "toys"]})


@query
def scan_domains(spark, sf):
    return sources.scan_domains(spark, _pairs_table(spark, sf))


@query
def latest_partition_within(spark, sf):
    """Of a table by run and month, where the catalog looks up one run's months."""
    table = "fx_runs_" + hashlib.sha256(sf.encode()).hexdigest()[:8]

    def write(path):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        rows = _snapshots(spark, sf).withColumns({
            "run": F.concat(F.lit("run="), F.col("run_no")),
            "load_month": F.substring("load_date", 1, 7)})
        rows.write.partitionBy("run", "load_month").option("path", path).saveAsTable(table)
    _copy(spark, sf, table, write)
    listed = sources.table_partitions(spark, table, {"run": "string", "load_month": "string"},
                                      within={"run": "run=2"})
    return sources.latest_partition(spark.table(table), ["load_month"], F.col("run") == "run=2",
                                    partitions=listed)


@query
def stage_json(spark, sf):
    """Bad lines of review files, which are kept by day; every seventh date's are cut short."""
    def write(path):
        lines = _reviews(spark, sf).select(F.to_json(F.struct("*")).alias("line"), "match_date")
        cut = F.col("line").substr(F.lit(1), F.length("line") - 1)
        lines.select(F.when(F.col("match_date").cast("bigint") % 7 == 0, cut).otherwise(
            F.col("line")).alias("line")).write.options(**sources.PACKED).text(f"{path}/lines")
        for day in (LOAD_DAY, NEXT_DAY):
            _, bad, counts = sources.stage_json(spark, f"{path}/lines", REVIEW)
            sources.replace_day(bad, f"{path}/bad", day, counts["bad_lines"])
    path = _copy(spark, sf, "fx_reviews_cut", write)
    # The cut lines as rows again: what is missing is their last bracket.
    kept = spark.read.schema("line string, year string, month string, day string").parquet(
        f"{path}/bad")
    whole = F.concat("line", F.lit("}"))
    return kept.select(F.get_json_object(whole, "$.base_sku").alias("base_sku"),
                       F.get_json_object(whole, "$.match_date").alias("match_date"),
                       "year", "month", "day")


@query
def union_sources(spark, sf):
    return plans.union_sources(review_sources(spark, sf))


@query
def next_run_number(spark, sf):
    return sources.next_run_number(_snapshots(spark, sf), RUN_DAY)


@query
def stamp_load_date(spark, sf):
    return op.stamp_load_date(op.drop_cols(_pairs(spark, sf), "year", "month", "day"), LOAD_DAY)


def _warehouse_copy(spark, sf, fmt):
    return _copy(spark, sf, f"warehouse_{fmt}", lambda path: sources.write_warehouse(
        warehouse_from_sources(spark, sf), path, fmt))


@query
def write_warehouse(spark, sf):
    return sources.read_warehouse(spark, _warehouse_copy(spark, sf, "parquet"))


@query
def write_warehouse_csv(spark, sf):
    return sources.read_warehouse(spark, _warehouse_copy(spark, sf, "csv"), "csv")


@query
def write_warehouse_json(spark, sf):
    return sources.read_warehouse(spark, _warehouse_copy(spark, sf, "json"), "json")


@query
def publish_day(spark, sf):
    """Two days of a table, the first published twice and the second laid out for lookups."""
    table = "fx_published_" + hashlib.sha256(sf.encode()).hexdigest()[:8]

    def write(path):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        # Published three times, computed once.
        whole, stage = warehouse_from_sources(spark, sf), scratch_dir(spark, "to_publish")
        whole.write.options(**sources.COLUMNAR).parquet(stage)
        rows = spark.read.schema(whole.schema).parquet(stage)
        limits = [sources.Limit("row_count", least=1), sources.Limit("type_other", most=0)]
        sources.publish_day(rows.where(F.col("type") == REJECT), table, LOAD_DAY, path=path)
        sources.publish_day(rows, table, LOAD_DAY, limits=limits)
        sources.publish_day(rows, table, NEXT_DAY, limits=limits, lookup=["sku_uuid_a"])
        sources.drop_old_versions(spark, table, LOAD_DAY)
        remove(spark, stage)
    _copy(spark, sf, table, write)
    return spark.table(table)


@query
def count_metrics(spark, sf):
    return sources.count_metrics(warehouse_from_sources(spark, sf))


@query
def order_for_lookup(spark, sf):
    return sources.order_for_lookup(_keyed_pairs(spark, sf), within=())


@query
def quarantine_by_day(spark, sf):
    """Pairs without ids of two days' loads, apart from the others in one pass each."""
    def write(path):
        session = compiled_session(spark)
        labelled = plans.labelled_pairs(library(session, sf), review_sources(session, sf),
                                        feeds(session, sf))
        for day in (LOAD_DAY, NEXT_DAY):
            _, bare, count = plans.split_bare(labelled)
            sources.replace_day(bare, path, day, count)
    path = _copy(spark, sf, "quarantine", write)
    return sources.read_warehouse(spark, path, schema=DATED_LABELLED)


@query
def write_split(spark, sf):
    def write(path):
        sources.write_split(warehouse_from_sources(spark, sf),
                            {(EXACT, SIMILAR): f"{path}/matches", (REJECT,): f"{path}/rejects"})
    path = _copy(spark, sf, "split", write)
    return op.tag(sources.read_warehouse(spark, f"{path}/matches"), target="matches").unionByName(
        op.tag(sources.read_warehouse(spark, f"{path}/rejects"), target="rejects"))


@query
def write_split_rest(spark, sf):
    def write(path):
        rows = warehouse_from_sources(spark, sf)
        sources.write_split(rows.withColumn("type", F.when(F.col("type") != REJECT, F.col("type"))),
                            {(EXACT,): f"{path}/exact"}, rest=f"{path}/rest")
    path = _copy(spark, sf, "split_rest", write)
    return op.tag(sources.read_warehouse(spark, f"{path}/exact"), target="exact").unionByName(
        op.tag(sources.read_warehouse(spark, f"{path}/rest"), target="rest"))


@query
def rebalance(spark, sf):
    return sources.rebalance(_pairs(spark, sf), "year", "month", "day")


@query
def count_rows(spark, sf):
    return sources.count_rows(_pairs(spark, sf))


# ---- Projections ------------------------------------------------------------------------

@query
def conform_(spark, sf):
    return conform(_pairs(spark, sf).withColumn("score", F.col("score").cast("int")), FEED)


@query
def drop_cols(spark, sf):
    return op.drop_cols(_pairs(spark, sf), "year", "month", "day")


@query
def rename_cols(spark, sf):
    return op.rename_cols(_pairs(spark, sf), {"domain": "segment", "score": "scores"})


@query
def tag(spark, sf):
    return op.tag(_pairs(spark, sf), match_source="upc", type=EXACT, segment=PETS)


@query
def fill_blank(spark, sf):
    return _filled(spark, sf)


@query
def to_epoch_int(spark, sf):
    return _reviews(spark, sf).select("match_date", ids.to_epoch_int("match_date")
                                      .alias("match_timestamp"))


@query
def lower_cols(spark, sf):
    return op.lower_cols(library(spark, sf), "model_used")


# ---- Filters ----------------------------------------------------------------------------

@query
def exclude_values(spark, sf):
    return op.exclude_values(_reviews(spark, sf), "workflow", DROPPED_WORKFLOWS)


@query
def exclude_company(spark, sf):
    return op.exclude_values(library(spark, sf), "company_code", [DROPPED_COMPANY])


@query
def live_rows(spark, sf):
    return op.live_rows(library(spark, sf))


@query
def deleted_rows(spark, sf):
    return op.deleted_rows(library(spark, sf))


@query
def deleted_rows_strict(spark, sf):
    return op.deleted_rows(library(spark, sf), strict=True)


@query
def keep_companies(spark, sf):
    return op.keep_values(library(spark, sf), "company_code", ["chewy", "petco"])


@query
def keep_models(spark, sf):
    return op.keep_values(library(spark, sf), "model_used", PETS_MODELS["fastlane"])


@query
def keep_containing(spark, sf):
    return op.keep_containing(op.lower_cols(library(spark, sf), "model_used"), "model_used",
                              "fastlane", "ml")


@query
def keep_match_kind(spark, sf):
    return op.keep_values(library(spark, sf), "match", ["similar"])


@query
def keep_review_states(spark, sf):
    return op.keep_values(library(spark, sf), "customer_review_state", VERIFIED_STATES)


@query
def non_blank(spark, sf):
    return op.non_blank(_filled(spark, sf), "base_sku")


@query
def non_blank_strict(spark, sf):
    return op.non_blank(_filled(spark, sf), "base_sku", strict=True)


@query
def answer_flags(spark, sf):
    reviews = _reviews(spark, sf)
    decided = [*EXACT_ANSWERS, *REJECT_ANSWERS, *UNDECIDED_ANSWERS]
    return (op.tag(op.keep_values(reviews, "answer", EXACT_ANSWERS), type=EXACT)
            .unionByName(op.tag(op.keep_values(reviews, "answer", REJECT_ANSWERS), type=REJECT))
            .unionByName(op.tag(op.exclude_values(reviews, "answer", decided), type=SIMILAR)))


@query
def keep_types(spark, sf):
    return op.keep_values(op.route_reviews(_reviews(spark, sf)), "type", [EXACT, SIMILAR])


# ---- Scalar expressions -----------------------------------------------------------------

@query
def product_uuid(spark, sf):
    return op.add_uuids(_filled(spark, sf)).select("uuid_a", "uuid_b")


@query
def join_key(spark, sf):
    return _pairs(spark, sf).select(
        "uuid_a", ids.join_key("uuid_a", "sku").alias("by_sku"),
        ids.join_key("uuid_a", "upc").alias("by_upc"),
        ids.join_key("uuid_a", F.col("domain") == PETS).alias("by_domain"))


@query
def is_placeholder(spark, sf):
    rows = library(spark, sf)
    return rows.select("base_upc", "comp_sku",
                       ids.is_placeholder("base_upc").alias("no_upc"),
                       ids.is_placeholder(F.lower("comp_sku")).alias("no_sku"))


@query
def lacks_ids(spark, sf):
    return op.add_uuids(_filled(spark, sf)).select("uuid_a", ids.lacks_ids("uuid_a").alias("bare"))


@query
def add_join_keys(spark, sf):
    return op.add_join_keys(_pairs(spark, sf), "sku")


@query
def store_key(spark, sf):
    return op.add_stores(_pairs(spark, sf))


@query
def parts_to_epoch(spark, sf):
    return _pairs(spark, sf).select(
        "day", "month", "year", ids.parts_to_epoch("day", "month", "year").alias("match_timestamp"))


@query
def canonical_pair(spark, sf):
    return op.canonical_pair(_pairs(spark, sf))


@query
def orient_pairs(spark, sf):
    return op.orient_pairs(_keyed_pairs(spark, sf))


@query
def rewrite_alias(spark, sf):
    return op.rewrite_alias(_keyed_pairs(spark, sf))


@query
def store_from_uuid(spark, sf):
    return library(spark, sf).select(
        "base_source_store", ids.store_from_uuid("base_source_store").alias("store"))


# ---- Routing ----------------------------------------------------------------------------

@query
def route_segment(spark, sf):
    return op.route_segment(library(spark, sf))


@query
def route_reject_source(spark, sf):
    return op.route_reject_source(library(spark, sf))


@query
def route_pets(spark, sf):
    return op.route_pets(op.live_rows(library(spark, sf)))


@query
def route_grocery(spark, sf):
    return op.route_grocery(op.live_rows(library(spark, sf)))


@query
def route_office(spark, sf):
    return op.route_office(op.live_rows(library(spark, sf)))


@query
def route_reviews(spark, sf):
    return op.route_reviews(_reviews(spark, sf))


# ---- Pairs ------------------------------------------------------------------------------

@query
def dedupe_uuid_pairs(spark, sf):
    return op.dedupe_pairs(op.canonical_pair(_pairs(spark, sf)), keys=("uuid_a", "uuid_b"),
                           order=("year", "month", "day"))


@query
def dedupe_pairs(spark, sf):
    return op.dedupe_pairs(_keyed_pairs(spark, sf))


@query
def dedupe_pairs_undirected(spark, sf):
    return op.dedupe_pairs(_keyed_pairs(spark, sf), undirected=True)


@query
def earliest_per_pair(spark, sf):
    return op.earliest_per_pair(_keyed_pairs(spark, sf))


@query
def prune_rejected_directed(spark, sf):
    return op.prune_rejected(_keyed_pairs(spark, sf), library_rejects(spark, sf), undirected=False)


@query
def prune_rejected(spark, sf):
    return op.prune_rejected(_keyed_pairs(spark, sf), library_rejects(spark, sf))


@query
def mirror_pairs(spark, sf):
    return op.mirror_pairs(_keyed_pairs(spark, sf))


@query
def union_feeds(spark, sf):
    frames = [op.rename_cols(f, {"scores": "score"}) for f in feeds(spark, sf).values()]
    return union_conformed(frames, FEED)


@query
def union_classes(spark, sf):
    rows = op.live_rows(library(spark, sf))
    return (op.route_grocery(rows).unionByName(op.route_pets(rows))
            .unionByName(op.route_office(rows)))


def _families(spark, sf):
    matches = library_matches(spark, sf)
    pair_feeds = feeds(spark, sf)
    return [(matches, [F.col("segment") == s for s in (GROCERY, PETS, OFFICE)]),
            review_matches(spark, sf),
            *(plans.feed_matches(pair_feeds[f], f) for f in ("transitive", "exact_desc", "upc"))]


@query
def combine_matches(spark, sf):
    return op.combine_matches(_families(compiled_session(spark), sf))


@query
def combine_rejects(spark, sf):
    spark = compiled_session(spark)
    return op.combine_rejects([library_rejects(spark, sf), review_rejects(spark, sf)])


@query
def matches_and_rejects(spark, sf):
    spark = compiled_session(spark)
    return op.settle_pairs(op.combine([combine_matches(spark, sf), combine_rejects(spark, sf)]))


# ---- Flows ------------------------------------------------------------------------------

@query
def library_matches(spark, sf):
    return plans.library_matches(library(spark, sf))


@query
def library_matches_strict(spark, sf):
    return plans.library_matches(library(spark, sf), "sku", strict=True)


@query
def library_rejects(spark, sf):
    return plans.library_rejects(library(spark, sf))


@query
def library_pairs(spark, sf):
    return plans.library_pairs(library(spark, sf))


@query
def review_matches(spark, sf):
    return plans.review_matches(review_sources(spark, sf))


@query
def review_rejects(spark, sf):
    return plans.review_rejects(review_sources(spark, sf))


@query
def feed_matches_upc(spark, sf):
    return plans.feed_matches(feeds(spark, sf)["upc"], "upc")


@query
def feed_matches_exact_desc(spark, sf):
    return plans.feed_matches(feeds(spark, sf)["exact_desc"], "exact_desc")


@query
def feed_matches_transitive(spark, sf):
    return plans.feed_matches(feeds(spark, sf)["transitive"], "transitive", "sku")


@query
def build_warehouse(spark, sf):
    spark = compiled_session(spark)
    return plans.build_warehouse(combine_matches(spark, sf), combine_rejects(spark, sf), LOAD_DAY)


def _from_sources(spark, sf, **options):
    spark = compiled_session(spark)
    return plans.warehouse_from_sources(library(spark, sf), review_sources(spark, sf),
                                        feeds(spark, sf), LOAD_DAY, **options)


@query
def warehouse_from_sources(spark, sf):
    return _from_sources(spark, sf)


@query
def warehouse_sku_first(spark, sf):
    return _from_sources(spark, sf, prefer="sku")


@query
def warehouse_prefer_by_segment(spark, sf):
    return _from_sources(spark, sf, prefer=F.col("segment") == PETS)


@query
def warehouse_of_domains(spark, sf):
    return _from_sources(spark, sf, domains=[PETS, "toys"])


@query
def warehouse_of_whole_pairs(spark, sf):
    return _from_sources(spark, sf, drop_half_null=True)


@query
def warehouse_of_all_workflows(spark, sf):
    return _from_sources(spark, sf, dropped_workflows=["none"])


@query
def warehouse_without_bare(spark, sf):
    return _from_sources(spark, sf, drop_bare=True)


@query
def bare_pairs(spark, sf):
    return plans.bare_pairs(library(spark, sf), review_sources(spark, sf), feeds(spark, sf))


@query
def warehouse_pruned(spark, sf):
    return _from_sources(spark, sf, prune=True, alias_rejects=True)


@query
def warehouse_undirected(spark, sf):
    return _from_sources(spark, sf, undirected=True)
