import re

import pytest

from pairloom.llm.shipping import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def awkward(spark):
    """Nulls everywhere, empty and long texts, repeated rows, columns with clashing names."""
    texts = [None, "", " \n\t ", "One", "two  WORDS\x0bé", "a " * 30_000,
             "word " * 5 + "\n" + "word " * 5, "\x85\xa0 nbsp\x1cfs", "x" * 200_000,
             "mail me at kid@host.example.com or +1 (017) 555-7713 now", "é🙂 \U0001f600 ￿"]
    rows = [(i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows += [(None, "no id at all here", None, None, 0), (None, None, None, None, None)]
    rows += [(3, "One", "en", "s0", None)] * 2
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("id", "key", "class", "size", "row", "hash", "token", "kept", "spans", "_text",
                 "_row", "_id", "_label", "n_tokens", "score", "bucket", "source_key", "digest",
                 "payload", "_base", "terms", "ids", "host", "shard"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame
