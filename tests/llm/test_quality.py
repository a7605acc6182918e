from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from conftest import WORD, words

from pairloom.llm import quality_classifier, quality_rules
from pairloom.llm.queries import QUERIES


def base(text):
    text, found = text or "", words(text)
    windows = [tuple(found[i:i + 8]) for i in range(len(found) - 7)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), repeated,
            len(covered), failed)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for row in QUERIES["op3_quality_rules"](spark, sf_dir).collect():
        assert tuple(row[f] for f in FIELDS) == base(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_base_counts_of_odd_texts():
    texts = [None, "", "\n\n", "a", "a\na\n a\na", "x " * 50, "é\x0bÉ\x0c\x85\xa0z", "#*$%&|<>",
             "l\r\n" * 5, ("a b c d e f g h i " * 3).strip(), "a\n\nb\n", "tail\n"]
    found = quality_rules.Lines(pa.array(texts)).base()
    for i, text in enumerate(texts):
        assert tuple(found[f][i] for f in FIELDS[:5]) == base(text)[:5]


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    model = quality_rules.LineCrf(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    lengths = [1, 4, 6, 0, 3]
    rows = np.repeat(np.arange(5), lengths)
    x = rng.integers(0, 2, (len(rows), 3))
    found = model.viterbi(x, rows, 5)
    for i in range(5):
        own = x[rows == i] @ model.emit
        def worth(s):
            return (sum(own[t, a] for t, a in enumerate(s))
                    + sum(model.step[a, b] for a, b in zip(s, s[1:])))
        best = max(product((0, 1), repeat=lengths[i]), key=worth)
        assert worth(tuple(found[rows == i])) == pytest.approx(worth(best))


def test_crf_gradient_fits_expectations():
    rng = np.random.default_rng(2)
    chains = [rng.integers(0, 2, (n, 4)).astype(np.uint8) for n in (3, 1, 5, 2)]
    model = quality_rules.LineCrf.fit(chains, [1, 0, 1, 0], rounds=5)
    live, begins, order = [4, 3, 2, 1, 1], np.cumsum([0, 4, 3, 2, 1, 1]), [2, 0, 3, 1]
    x = np.concatenate([[chains[i][t] for i in order[:n]] for t, n in enumerate(live)])
    marginal, pair = model._expected(x @ model.emit, model.step, live, begins)
    exact, moves = np.zeros_like(marginal), np.zeros((2, 2))
    for place, i in enumerate(order):
        own = chains[i] @ model.emit
        ways = list(product((0, 1), repeat=len(own)))
        weight = np.exp([sum(own[t, a] for t, a in enumerate(s))
                         + sum(model.step[a, b] for a, b in zip(s, s[1:])) for s in ways])
        for s, p in zip(ways, weight / weight.sum()):
            for t, a in enumerate(s):
                exact[begins[t] + place, a] += p
            for a, b in zip(s, s[1:]):
                moves[a, b] += p
    assert np.allclose(marginal, exact) and np.allclose(pair, moves)


def test_verdicts_follow_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op3_quality_rules"](spark, sf_dir).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.25


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op5_quality_classifier"](spark, sf_dir).join(labels, "doc_id").where(
        "held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_do_not_matter(spark, sf_dir, documents):
    import zlib
    held = [r.doc_id for r in documents.select("doc_id").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    from pyspark.sql import functions as F

    from pairloom.llm.queries import crc_remainder
    turned = labels.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    models = [quality_classifier.fit(documents, some, among=lambda i: crc_remainder(i, 4) != 2)
              for some in (labels, turned)]
    assert (models[0].weights == models[1].weights).all()


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(
        [(3, 1), (3, 1), (5, 0), (9, 1), (None, 0), (4, None), (99, 0)],
        "doc_id bigint, quality int")
    crf = quality_rules.fit(awkward, labels)
    texts = sorted(base(r.text) for r in awkward.collect())
    judged = quality_rules.judge(awkward, crf)
    assert sorted(tuple(r[f] for f in FIELDS) for r in judged.collect()) == texts
    kept = quality_rules.keep(awkward, crf)
    assert kept.columns == awkward.columns and kept.count() == judged.where("kept").count()
    model = quality_classifier.fit(awkward, labels)
    scores = quality_classifier.score(awkward, model).collect()
    assert len(scores) == len(texts) and all(0 <= r.score <= 1 for r in scores)


def test_empty_tables(spark, awkward):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality_rules.fit(awkward, none) is None
    assert quality_rules.judge(awkward.where("false"), None).count() == 0
    assert quality_rules.judge(awkward, None).where("kept and base_failed").count() == 0
    model = quality_classifier.fit(awkward, none)
    assert {r.score for r in quality_classifier.score(awkward, model).collect()} == {0.5}
