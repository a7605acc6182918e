"""One query per operator of this subpackage, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    bpe,
    jaccard_join,
    lm_scoring,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    topk_search,
    url_filters,
    vector_codes,
    warc,
    whitening,
)
from .oracles import ORACLES
from .shipping import ship

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Query) -> Query:
    @wraps(fn)
    def shipped(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(id_col: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n."""
    return F.crc32(id_col.cast("string")) % n


@query
def op1_topk(spark, sf_dir):
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op2_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER, ids=False, digests=True)


@query
def op3_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.fit(docs, labels))


URL_RULES = [url_filters.Rule("allow", "com/"), url_filters.Rule("block", "example.com/en/"),
             url_filters.Rule("allow", "www.example.com/en/"),
             url_filters.Rule("block", "net/es/"), url_filters.Rule("block", "net/fr/")]


@query
def op4_url_filters(spark, sf_dir):
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("blocked_share")


@query
def op5_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, among=lambda i: crc_remainder(i, 4) != 2)
    return quality_classifier.score(docs, model).select(
        "doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias(
            "held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op6_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@query
def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@query
def op9_mixing(spark, sf_dir):
    return mixing.draws(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "shards")


@query
def op10_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return lm_scoring.score_held_out(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").try_cast("bigint"))


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


@query
def op13_suffix_dedup(spark, sf_dir):
    return suffix_dedup.find(table(spark, sf_dir, "documents")).drop("removed")
