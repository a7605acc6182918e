"""The stages that turn raw documents into encoded training text."""

from __future__ import annotations

from pairloom.llm import bpe, jaccard_join, mixing, pii, quality_rules
from pairloom.llm.queries import TOKENIZER
from pairloom.llm.shipping import ship
from pairloom.scratch import scratch_dir


def keep_content(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep(docs, quality_rules.fit(docs, labels))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group whose five-word shingles are alike to 0.8 or more."""
    ship(spark)
    return jaccard_join.keep_one(docs, n=5, percent=80)


def remove_personal_data(spark, docs, sf_dir):
    """All documents, without personal data and the terms that reveal it."""
    return pii.sanitise(docs, length_col="n_chars")


def mix_sources(spark, docs, sf_dir):
    """Documents as often as their source's share takes them."""
    ship(spark)
    return mixing.mix(docs)


def encode_text(spark, docs, sf_dir):
    """Token ids of every document: doc_id, n_tokens, ids."""
    ship(spark)
    return bpe.encode(docs, TOKENIZER)


STAGES = [("quality_rules", keep_content), ("jaccard_join", drop_near_duplicates),
          ("pii", remove_personal_data), ("mixing", mix_sources), ("bpe", encode_text)]

#: Stages fit models, draw by hashes and merge text by rules that SQL does not express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Every stage over `documents`, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
