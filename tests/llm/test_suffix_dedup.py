"""Repeated bytes against sets of substrings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pairloom.llm import queries, suffix_dedup
from pairloom.llm.bwt import join_pieces, open_borders, repeated_starts, suffix_array


def brute_starts(pieces, least):
    counts = Counter(p[i:i + least] for p in pieces for i in range(len(p) - least + 1))
    return [[i + least <= len(p) and counts[p[i:i + least]] > 1 for i in range(len(p))]
            for p in pieces]


def expected(texts, least):
    """n_bytes, n_removed, n_spans, kept_sha256 of each text."""
    raws = [(t or "").encode() for t in texts]
    out = []
    for raw, starts in zip(raws, brute_starts(raws, least)):
        covered = bytearray(len(raw))
        for i, found in enumerate(starts):
            if found:
                covered[i:i + least] = b"\1" * least
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, least, **options):
    rows = suffix_dedup.find(docs, least=least, **options).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def check(spark, texts, least, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = Counter((i, *e) for i, e in enumerate(expected(texts, least)))
    assert found(docs, least, **options) == want


def test_transform_against_substrings():
    rng = random.Random(1)
    for _ in range(400):
        letters = rng.choice([1, 2, 3, 5])
        pieces = [bytes(rng.randrange(letters) for _ in range(rng.randrange(30)))
                  for _ in range(rng.randrange(1, 8))]
        pieces += pieces[:rng.randrange(2)]
        least = rng.randrange(1, 12)
        want = [x for p in brute_starts(pieces, least) for x in [*p, False]]
        assert repeated_starts(pieces, least).tolist() == want


def test_borders_are_open_from_the_common_prefix_on():
    pieces = [b"banana", b"bandana", b"ananas"]
    text = join_pieces(pieces)
    order, rank = suffix_array(text)
    assert (rank[order] == np.arange(len(text))).all()
    tails = [p[i:] for p in pieces for i in range(len(p) + 1)]

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for least in range(1, 8):
        is_open = open_borders(text, order, rank, least)
        for place in range(1, len(order)):
            both = tails[order[place - 1]], tails[order[place]]
            assert is_open[place] == (common(*both) >= least)


def random_texts(rng, letters, n):
    passages = ["".join(rng.choices(letters, k=rng.randrange(5, 60))) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = ["".join(rng.choices(letters, k=rng.randrange(30)))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(passages), "".join(rng.choices(letters, k=rng.randrange(20)))]
        texts.append("".join(parts))
    return texts + [texts[0], texts[0], None, "", passages[0]]


@pytest.mark.parametrize("large", [1, 1000])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh é🙂"])
def test_random_texts(spark, letters, large):
    rng = random.Random(large)
    check(spark, random_texts(rng, letters, 60), 16, shard_bytes=400, large=large)


@pytest.mark.parametrize("large", [1, 1000])
def test_periodic_texts(spark, large):
    texts = ["a" * 5000, "ab" * 700 + "c", "x" + "abc" * 40, "unlike any other text that stands here",
             "0123456789" * 3 + "z", "q" * 19, "q" * 20 + "r"]
    check(spark, texts, 20, large=large)


def test_long_text_in_blocks(spark, monkeypatch):
    rng = random.Random(3)
    tail = "".join(rng.choices("abcdef ", k=60))
    text = "".join(rng.choices("abcdefghij ", k=9000))
    blocks = list(suffix_dedup._blocks(np.zeros(3 << 20, np.uint8), np.array([0, 3 << 20]), 400))
    assert [int(b[3][0]) for b in blocks] == [0, 1 << 20, 2 << 20]
    assert len(blocks[0][0]) == (1 << 20) + 399
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 500)
    pieces = [suffix_dedup.Pieces(d, o, 40) for d, o, *_ in suffix_dedup._blocks(
        np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 40)]
    assert sum(int((p.sizes - 39).sum()) for p in pieces) == len(text) - 39
    check(spark, [text + tail, tail + "0", text[4000:4100]], 40)


def test_hot_passage_and_copies(spark):
    rng = random.Random(5)
    hot = "".join(rng.choices("abcdefghij ", k=50))
    texts = ["".join(rng.choices("abcdefghij ", k=30)) + hot + "".join(
        rng.choices("abcdefghij ", k=30)) for _ in range(150)]
    texts += [texts[0]] * 100 + [hot] * 3
    for large in (10, 1000):
        check(spark, texts, 24, large=large)


def test_awkward_rows(spark, awkward):
    texts = [r.text for r in awkward.select("text").collect()]
    rows = awkward.collect()
    want = Counter((r.doc_id, *e) for r, e in zip(rows, expected(texts, 400)))
    assert found(awkward, 400) == want
    left = suffix_dedup.remove(awkward)
    assert left.columns == awkward.columns
    kept = {(r.doc_id, r.text) for r in left.collect()}
    assert kept >= {(None, None), (0, None), (1, ""), (3, "One")}
    assert len(next(t for i, t in kept if i == 8)) == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.find(none).collect() == [] == suffix_dedup.remove(none).collect()


def test_query(spark, sf_dir, documents):
    rows = documents.collect()
    want = Counter((r.doc_id, *e) for r, e in zip(rows, fast_expected(rows)))
    out = queries.QUERIES["op13_suffix_dedup"](spark, sf_dir)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"),
                          ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert Counter(tuple(r) for r in out.collect()) == want


def fast_expected(rows, least=400):
    """`expected`, with hashes of the substrings in place of them."""
    raws = [(r.text or "").encode() for r in rows]
    counts = Counter(hash(raw[i:i + least]) for raw in raws for i in range(len(raw) - least + 1))
    out = []
    for raw in raws:
        covered = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - least + 1):
            if counts[hash(raw[i:i + least])] > 1:
                covered[i] += 1
                covered[i + least] -= 1
        held = np.cumsum(covered)[:-1] > 0
        spans = int((held & ~np.concatenate([[False], held[:-1]])[:len(held)]).sum())
        kept = np.frombuffer(raw, np.uint8)[~held].tobytes()
        out.append((len(raw), int(held.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
