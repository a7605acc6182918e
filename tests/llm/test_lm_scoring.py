import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import words

from pairloom.llm import gru, lm_scoring
from pairloom.llm.queries import QUERIES


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_scores(rows):
    tokens = [words(text, lower=True) + [None] for _, text in rows]
    counts = Counter(t for (i, _), ts in zip(rows, tokens) if not held_out(i) for t in ts)
    total, distinct = sum(counts.values()), len(counts)
    return [(len(ts), sum(counts[t] > 0 for t in ts), total,
             sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in ts))
            for ts in tokens]


IS_TRAINING = "NOT coalesce(crc32(CAST(doc_id AS string)) % 7 = 2, false)"


def check(frame, rows):
    found = lm_scoring.score_held_out(frame, IS_TRAINING).collect()
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    assert len(got) == len(rows)
    for one, other in zip(got, sorted(base_scores(rows))):
        assert one[:3] == other[:3] and one[3] == pytest.approx(other[3])
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    return found


@pytest.mark.parametrize("head", [1, 50, 1 << 17])
def test_base_scores(documents, monkeypatch, head):
    """Whatever part of the counts goes to the tasks, the rest is joined."""
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(awkward):
    check(awkward, [(r.doc_id, r.text) for r in awkward.collect()])
    assert lm_scoring.score_held_out(awkward.where("false"), IS_TRAINING).count() == 0
    only = awkward.where("doc_id is not null and crc32(cast(doc_id as string)) % 7 = 2")
    for row in lm_scoring.score_held_out(only, IS_TRAINING).collect():
        assert row.base_score == row.n_known == row.train_tokens == 0


def test_query_learns_from_its_training_documents_only(spark):
    rows = QUERIES["op10_lm_scoring"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    unseen = [r for r in rows if r.held_out]
    # The network knows what language a text is in; single counts do not.
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def numbers(seed=0, n=3, t=6):
    rng = np.random.default_rng(seed)
    p = {k: v.astype(float) * (3 if k in ("input", "state") else 1)
         for k, v in gru.initial(rng.integers(1, 90, gru.SIZE)).items()}
    targets = rng.integers(0, gru.SIZE, (n, t))
    starts = rng.random((n, t)) < 0.3
    given = rng.integers(0, gru.SIZE, (n, t))
    given[starts] = gru.START
    return p, given, targets, starts


def loss(p, given, targets, starts):
    h, total = np.zeros((len(given), gru.HIDDEN)), 0.0
    for t in range(given.shape[1]):
        h, _ = gru._step(p, given[:, t], h * ~starts[:, t, None])
        total -= gru.log_probability(p, h, targets[:, t]).sum()
    return total


def test_gradients():
    p, given, targets, starts = numbers()
    trainer = gru.Trainer(p)
    trainer.p, held = p, {}
    trainer._update = lambda grads, tokens: held.update(grads)
    trainer._window(np.zeros((3, gru.HIDDEN)), given, targets, starts)
    for name, grad in held.items():
        for at in map(tuple, np.argwhere(np.abs(grad) > 1e-2)[::97]):
            kept, values = p[name][at], []
            for step in (1e-5, -1e-5):
                p[name][at] = kept + step
                values.append(loss(p, given, targets, starts))
            p[name][at] = kept
            assert (values[0] - values[1]) / 2e-5 == pytest.approx(grad[at], rel=1e-3, abs=1e-6)


def test_probabilities_sum_to_one():
    p, *_ = numbers(1)
    states = np.random.default_rng(2).normal(size=(2, gru.HIDDEN))
    for state in states:
        logs = gru.log_probability(p, np.repeat(state[None], gru.SIZE, 0), np.arange(gru.SIZE))
        assert np.exp(logs).sum() == pytest.approx(1)


@pytest.mark.parametrize("lanes", [1, 2, 7])
def test_lanes_carry_each_text_alone(lanes):
    p, *_ = numbers(3)
    rng = np.random.default_rng(4)
    counts = np.array([5, 0, 40, 1, 12, 3, 0, 9])
    tokens = rng.integers(0, gru.SIZE, counts.sum())
    together = gru.score(p, tokens, counts, lanes)
    at = 0
    for count in counts:
        own, h = tokens[at:at + count], np.zeros((1, gru.HIDDEN))
        for t, token in enumerate(own):
            h, _ = gru._step(p, np.array([own[t - 1] if t else gru.START]), h)
            assert together[at + t] == pytest.approx(
                gru.log_probability(p, h, np.array([token]))[0], rel=1e-5)
        at += count


def test_training_uses_every_token():
    p = gru.initial(np.ones(gru.SIZE))
    trainer = gru.Trainer(p)
    rng = np.random.default_rng(5)
    for size in (10, 3000, 777, 1):
        trainer.feed(rng.integers(0, 40, size), rng.random(size) < 0.05)
    trainer.feed(np.empty(0, np.int64), np.empty(0, bool), last=True)
    assert trainer.tokens == 3788 and len(trainer.held[0]) == 0
    text = rng.integers(0, 40, 500)
    assert gru.score(trainer.p, text, np.array([500])).mean() > gru.score(
        p, text, np.array([500])).mean()


def test_vocabulary_grows_with_the_input(spark, tmp_path):
    """Each of 3,000 words has an id, weights of its own that training moves, and a class."""
    rows = [(i, " ".join(f"w{(i * 100 + k) % 3000}" for k in range(300))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = lm_scoring.fit(docs, lm_scoring.F.lit(True), str(tmp_path))
    ids, counts = model.lookup(model.head)
    assert sorted(ids) == list(range(3001)) and (counts > 0).all() and model.other_total == 0
    start = gru.initial(np.append(model.head_counts[np.argsort(model.ids)], 0))
    assert len(model.params["bounds"]) > 33
    moved = np.abs(model.params["input"] - start["input"]).max(axis=1)
    end = ids[np.searchsorted(model.head, lm_scoring.END)]
    assert (np.delete(moved[:3001], end) > 0).all()


def test_gradients_of_any_number_of_ids():
    rng = np.random.default_rng(7)
    p = {k: v.astype(float) for k, v in gru.initial(1e4 / np.arange(1, 3001)).items()}
    targets = rng.integers(0, 3000, (4, 3))
    starts = np.zeros((4, 3), bool)
    given = rng.integers(0, 3000, (4, 3))
    trainer, held = gru.Trainer(p), {}
    trainer.p = p
    trainer._update = lambda grads, tokens: held.update(grads)
    trainer._window(np.zeros((4, gru.HIDDEN)), given, targets, starts)
    for name in ("input", "word_w", "word_b"):
        at = np.unravel_index(np.abs(held[name]).argmax(), held[name].shape)
        kept, values = p[name][at], []
        for step in (1e-5, -1e-5):
            p[name][at] = kept + step
            values.append(loss(p, given, targets, starts))
        p[name][at] = kept
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(held[name][at], rel=1e-3)


def stream(rng, sizes, ids=40):
    tokens = rng.integers(0, ids, sizes.sum())
    starts = np.zeros(len(tokens), bool)
    starts[np.cumsum(sizes) - sizes] = True
    return tokens, starts


@pytest.mark.parametrize("cuts", [[], [1, 2, 500], [333, 1200, 1201, 2900]])
def test_state_goes_on_from_feed_to_feed(monkeypatch, cuts):
    """Every token meets the state that its whole text has led to, however the stream is cut."""
    p, *_ = numbers(6)
    p = {k: v.astype(np.float32) if k != "bounds" else v for k, v in p.items()}
    tokens, starts = stream(np.random.default_rng(8), np.array([700, 3, 40, 1, 2000, 90, 166]))
    trainer, seen = gru.Trainer(p), []
    trainer._update = lambda grads, tokens: setattr(trainer, "tokens", trainer.tokens + tokens)
    trainer._update_rows = lambda grads: None
    output = trainer._output
    monkeypatch.setattr(trainer, "_output", lambda states, targets: (
        seen.append((states.copy(), targets)), output(states, targets))[1])
    for tokens_part, starts_part in zip(np.split(tokens, cuts), np.split(starts, cuts)):
        trainer.feed(tokens_part, starts_part)
    trainer.feed(np.empty(0, np.int64), np.empty(0, bool), last=True)
    assert trainer.tokens == len(tokens)
    expected, h = [], np.zeros((1, gru.HIDDEN), np.float32)
    for t, token in enumerate(tokens):
        h, _ = gru._step(p, np.array([gru.START if starts[t] else tokens[t - 1]]),
                         h * ~starts[[t], None])
        expected.append((token, *np.round(h[0], 3)))
    got = [(t, *np.round(s, 3)) for states, targets in seen for s, t in zip(states, targets)]
    np.testing.assert_allclose(sorted(got), sorted(expected), atol=5e-3)


def test_rows_wait_for_their_targets():
    """Rows of a class stay until enough targets of it are met; the last feed leaves none behind."""
    p = gru.initial(np.ones(gru.SIZE))
    tokens, starts = stream(np.random.default_rng(9), np.array([300, 500]), gru.SIZE)
    late, soon = gru.Trainer(p, ready=10 ** 6), gru.Trainer(p, ready=1)
    for trainer in (late, soon):
        trainer.feed(tokens, starts)
        trainer.feed(tokens[:0], starts[:0], last=True)
    assert late.errors == soon.errors == {}
    for trainer in (late, soon):
        moved = np.abs(trainer.p["word_w"] - p["word_w"]).max(axis=1)
        assert (moved > 0).all()


def test_logits_of_any_size_give_probabilities():
    p, *_ = numbers(2)
    p["word_b"][:40] = 5000
    p["class_b"][:] = -5000
    states = np.zeros((gru.SIZE, gru.HIDDEN))
    logs = gru.log_probability(p, states, np.arange(gru.SIZE))
    assert np.isfinite(logs).all() and np.exp(logs).sum() == pytest.approx(1)
