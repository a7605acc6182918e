import random
from hashlib import sha256

import numpy as np
import pytest
from tokenizers import Tokenizer

from pairloom.llm import bpe
from pairloom.llm.queries import QUERIES, TOKENIZER

LIBRARY = Tokenizer.from_file(TOKENIZER)


def expected(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts],
                                                add_special_tokens=False)]


def found(texts):
    return [np.frombuffer(i, "<u4").tolist()
            for i in bpe.tokenizer(TOKENIZER).encode([t or "" for t in texts])]


def test_odd_texts():
    rng = random.Random(3)
    texts = ["", "   ", "Ὀδυσσεύς ΣΑΣ", "İstanbul ſtraße ǅ", "a\x1cb \x1f d", "x\xa0y　z",
             "<|endoftext|> hi <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "don't WE'RE 'S",
             "日本語 １２ ²", "é é", "🙂👨‍👩‍👧", "\x00\x01abc", "a" * 5000, "ab" * 900,
             "​‍﻿"]
    texts += ["".join(rng.choice("etaoinshr lab.") for _ in range(200)) for _ in range(200)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x600),
                                      rng.randrange(0x1E00, 0x3000)])) for _ in range(40))
              for _ in range(500)]
    assert found(texts) == expected(texts)


def test_exact_merging_is_the_exception_but_right():
    tokenizer = bpe.tokenizer(TOKENIZER)
    words = [w.encode() for w in ("hello", "there", "thonerst", "aaaa", "zq")]
    assert [np.frombuffer(i, "<u4").tolist() for i in tokenizer.encode_words(words)] == \
        expected([w.decode() for w in words])


def test_overlapping_equal_pairs():
    texts = ["a" * n for n in range(1, 40)] + ["the" * n for n in range(1, 12)]
    assert found(texts) == expected(texts)


def test_forgetting(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBER", 3)
    texts = ["one two three four five six", "six seven one"]
    assert found(texts) == expected(texts) == found(texts)


def test_query(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    for doc_id, ids in zip(texts, expected(texts.values())):
        row = rows[doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_awkward_rows(awkward):
    rows = awkward.collect()
    encoded = bpe.encode(awkward, TOKENIZER)
    assert sorted(map(str, (tuple(r.ids) for r in encoded.collect()))) == sorted(
        map(str, map(tuple, expected(r.text for r in rows))))
    decoded = bpe.decode(encoded, TOKENIZER)
    assert sorted(r.decoded for r in decoded.collect()) == sorted(
        LIBRARY.decode(i, skip_special_tokens=False) for i in expected(r.text for r in rows))
    assert bpe.encode(awkward.where("false"), TOKENIZER).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    text = open(TOKENIZER, encoding="utf-8").read().replace('"NFC"', '"NFD"', 1)
    path = tmp_path / "other.json"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.WordBpe(str(path))
