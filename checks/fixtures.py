"""Input frames for checks and benchmarks, derived from the driver's tables.

The recipes are SQL that Spark and DuckDB both accept, so each check's input is the same on
both sides. They plant the hard cases: nulls, blanks, placeholder ids, leading zeros, stores
with one or three parts, an aliased store also in mixed case, overlapping model words, swapped
directions, duplicate pairs, pairs in several domains, unpadded days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FX_MATCH_LIBRARY = """
SELECT
  CASE WHEN l_partkey % 11 = 0 THEN '-' WHEN l_partkey % 13 = 0 THEN NULL
       WHEN l_partkey % 17 = 0 THEN '000'
       ELSE lpad(CAST(l_partkey AS STRING), 8, '0') END AS base_upc,
  CASE WHEN l_partkey % 7 = 0 THEN 'NA' WHEN l_partkey % 19 = 0 THEN NULL
       ELSE 'S' || CAST(l_partkey AS STRING) END AS base_sku,
  CASE WHEN l_partkey % 29 = 0 THEN 'solo' WHEN l_partkey % 5 = 0 THEN 'chewyinternal_chewyinternal'
       WHEN l_partkey % 5 = 1 THEN 'feed_staples_staples' ELSE 'chewy_chewy' END AS base_source_store,
  CASE WHEN l_orderkey % 40 = 3 THEN '' ELSE lpad(CAST(l_orderkey % 40 AS STRING), 6, '0') END AS comp_upc,
  CASE WHEN l_orderkey % 40 = 5 THEN 'undefined' ELSE 'C' || CAST(l_orderkey % 40 AS STRING) END AS comp_sku,
  CASE WHEN l_orderkey % 40 = 7 THEN NULL WHEN l_orderkey % 2 = 0 THEN 'amazon_amazon'
       ELSE 'jet_jet' END AS comp_source_store,
  CASE CAST(l_suppkey % 8 AS INT) WHEN 0 THEN 'chewy' WHEN 1 THEN 'petco' WHEN 2 THEN 'wholefoods'
       WHEN 3 THEN 'farmstead' WHEN 4 THEN 'staples' WHEN 5 THEN 'btfastlane'
       WHEN 6 THEN CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE 'imperfect' END
       ELSE 'agg_ml' END AS company_code,
  CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'product_not_found'
       ELSE 'product_found' END AS match_status,
  CASE WHEN l_linestatus = 'O' THEN 'customer_verified' ELSE 'unverified' END AS customer_review_state,
  CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN '2021-11-10' ELSE NULL END AS deleted_date,
  CASE WHEN l_quantity = 7 THEN NULL WHEN CAST(l_quantity AS INT) % 4 = 0 THEN 'similar'
       WHEN CAST(l_quantity AS INT) % 4 = 1 THEN 'equivalent' ELSE 'exact' END AS match,
  'true' AS active,
  CASE CAST((l_orderkey + 3 * l_linenumber) % 18 AS INT)
       WHEN 0 THEN 'ManualInternal' WHEN 1 THEN 'ManualExternal' WHEN 2 THEN 'MLT'
       WHEN 3 THEN 'Manual-a' WHEN 4 THEN 'SimEngineAutov1' WHEN 5 THEN 'SimEnginev1'
       WHEN 6 THEN 'ml_v1.0' WHEN 7 THEN 'ml' WHEN 8 THEN 'btfastlane-ml'
       WHEN 9 THEN 'btfastlane-ml_v1.0' WHEN 10 THEN 'btfastlaneMock-ml' WHEN 11 THEN 'UPCMatch'
       WHEN 12 THEN 'upc' WHEN 13 THEN 'btfastlane-upc' WHEN 14 THEN 'transitive'
       WHEN 15 THEN 'fastlane-Manual-x' WHEN 16 THEN 'other' ELSE NULL END AS model_used,
  CAST(CAST(round(l_discount * 100) AS INT) AS STRING) AS score,
  CAST(1600000000 + l_orderkey * 60 AS INT) AS match_date
FROM lineitem
"""

FX_REVIEWS = """
SELECT
  CAST(l_orderkey % 4 AS INT) AS feed,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE lpad(CAST(l_partkey AS STRING), 8, '0') END AS base_upc,
  CASE WHEN l_partkey % 7 = 0 THEN 'n/a' ELSE 'S' || CAST(l_partkey AS STRING) END AS base_sku,
  CASE WHEN l_partkey % 5 = 0 THEN 'chewyinternal_chewyinternal'
       WHEN l_partkey % 5 = 1 THEN 'chewyinternaL_chewyinternaL' ELSE 'chewy_chewy' END AS base_source_store,
  lpad(CAST(l_orderkey % 40 AS STRING), 6, '0') AS comp_upc,
  CASE WHEN l_orderkey % 40 = 5 THEN NULL ELSE 'C' || CAST(l_orderkey % 40 AS STRING) END AS comp_sku,
  CASE WHEN l_orderkey % 2 = 0 THEN 'amazon_amazon' ELSE 'jet_jet' END AS comp_source_store,
  CAST(CAST(round(l_tax * 100) AS INT) AS STRING) AS score,
  CAST(1600000000 + l_orderkey * 60 AS STRING) AS match_date,
  CASE CAST(l_suppkey % 6 AS INT) WHEN 0 THEN 'q_grocery' WHEN 1 THEN 'staples_q1'
       WHEN 2 THEN 'grocery_staples' WHEN 3 THEN NULL ELSE 'chewy_q' END AS queue_name,
  CASE CAST((l_orderkey + l_linenumber) % 9 AS INT) WHEN 0 THEN 'exact_match' WHEN 1 THEN 'exact_match_dq_issue'
       WHEN 2 THEN 'exact_match_with_image' WHEN 3 THEN 'not_a_match' WHEN 4 THEN 'not_match_image'
       WHEN 5 THEN 'not_match_dq_issue' WHEN 6 THEN 'unsure' WHEN 7 THEN 'size_variant' ELSE NULL END AS answer,
  CASE CAST(l_linenumber % 5 AS INT) WHEN 0 THEN 'internal-auditor' WHEN 1 THEN 'fastlane'
       WHEN 2 THEN NULL ELSE 'queue_1' END AS workflow
FROM lineitem
"""

FX_PAIRS = """
WITH s AS (
  SELECT l_linenumber, l_suppkey, l_orderkey, l_shipdate, l_discount,
    CASE WHEN l_partkey % 11 = 0 THEN '-' ELSE lpad(CAST(l_partkey AS STRING), 8, '0') END
      || '<>S' || CAST(l_partkey AS STRING) || '<>chewy<>chewy' AS x,
    lpad(CAST(l_orderkey % 40 AS STRING), 6, '0') || '<>C' || CAST(l_orderkey % 40 AS STRING)
      || CASE WHEN l_orderkey % 2 = 0 THEN '<>Amazon<>Amazon' ELSE '<>chewyinternal<>chewyinternal' END AS y
  FROM lineitem)
SELECT
  CASE CAST(l_suppkey % 3 AS INT) WHEN 0 THEN 'upc' WHEN 1 THEN 'exact_desc' ELSE 'transitive' END AS feed,
  CASE WHEN l_linenumber % 2 = 0 THEN y ELSE x END AS uuid_a,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 2 = 0 THEN x ELSE y END AS uuid_b,
  CASE WHEN l_suppkey % 3 = 2 THEN CAST(extract(DAY FROM l_shipdate) AS STRING)
       ELSE lpad(CAST(extract(DAY FROM l_shipdate) AS STRING), 2, '0') END AS day,
  lpad(CAST(extract(MONTH FROM l_shipdate) AS STRING), 2, '0') AS month,
  CAST(extract(YEAR FROM l_shipdate) AS STRING) AS year,
  CAST(CAST(round(l_discount * 100) AS INT) AS STRING) AS score,
  CASE CAST((l_orderkey + l_linenumber) % 5 AS INT) WHEN 0 THEN 'pets' WHEN 1 THEN 'office_supplies'
       WHEN 2 THEN 'grocery' WHEN 3 THEN 'toys' ELSE NULL END AS domain
FROM s
"""

FX_SNAPSHOTS = """
SELECT o_orderkey, o_custkey, o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS load_date,
  CAST(extract(YEAR FROM o_orderdate) AS INT) AS year,
  CAST(extract(MONTH FROM o_orderdate) AS INT) AS month,
  CAST(extract(DAY FROM o_orderdate) AS INT) AS day,
  CAST(o_custkey % 3 + 1 AS INT) AS run_no
FROM orders
"""

#: Recipe and the table it reads.
RECIPES = {
    "fx_match_library": (FX_MATCH_LIBRARY, "lineitem"),
    "fx_reviews": (FX_REVIEWS, "lineitem"),
    "fx_pairs": (FX_PAIRS, "lineitem"),
    "fx_snapshots": (FX_SNAPSHOTS, "orders"),
}

REVIEW_SOURCES = 4
FEEDS = ("transitive", "exact_desc", "upc")


#: The library's date is an INT, as the source's catalog has it. Large order keys give seconds beyond
#: that type. As for the reviews' dates, and for all that `conform` cannot read, the column is null
#: there; the recipe's plain cast would fail the whole scan. A bound, as a failing `try_cast`
#: costs an exception to a row.
_SECONDS = "1600000000 + l_orderkey * 60"
_DATE = f"CAST({_SECONDS} AS INT)"
_DATE_OR_NULL = (f"CASE WHEN {_SECONDS} BETWEEN -2147483648 AND 2147483647 THEN {_DATE} END")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    recipe, table = RECIPES[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    recipe = recipe.replace(_DATE, _DATE_OR_NULL)
    return spark.sql(recipe.replace(f"FROM {table}", "FROM {source}"), source=source)


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_match_library")


def review_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    reviews = fixture(spark, sf_dir, "fx_reviews")
    return [reviews.where(F.col("feed") == i).drop("feed") for i in range(REVIEW_SOURCES)]


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The pair feeds by name; the transitive one calls its score `scores`."""
    pairs = fixture(spark, sf_dir, "fx_pairs")
    out = {f: pairs.where(F.col("feed") == f).drop("feed") for f in FEEDS}
    out["transitive"] = out["transitive"].withColumnRenamed("score", "scores")
    return out
