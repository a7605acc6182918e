"""Queries against their SQL, on the smallest tables."""

import pytest
from oracle import connect, difference

from pairloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, sf_dir, name):
    assert difference(connect(sf_dir), ORACLES[name], QUERIES[name](spark, sf_dir)) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


COLUMNS = {
    "op2_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string",
                "decoded_sha256": "string"},
    "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint",
                          "n_symbols": "bigint", "n_dup_lines": "bigint",
                          "n_repeat_words": "bigint", "base_failed": "boolean",
                          "kept": "boolean"},
    "op5_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double",
                               "predicted": "int"},
    "op6_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint",
                "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint",
                   "target": "double", "taken": "bigint"},
    "op10_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint",
                        "n_known": "bigint", "train_tokens": "bigint", "base_score": "double",
                        "score": "double"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, sf_dir, documents, name):
    found = QUERIES[name](spark, sf_dir)
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]
    assert found.select("doc_id").distinct().count() == found.count() == documents.count()
