"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL.

Features are hashed words, word pairs and, so that unseen words count too, the shapes of words
(letters and digits by class, other characters as they are) and whether a word repeats the one
before. A text's vector holds the share of each feature, damped in short texts. Weights come from
follow-the-regularised-leader updates over a bounded sample of labelled documents
(`SAMPLE_DOCS` documents of at most `SAMPLE_WORDS` words); a score is one sparse dot product,
added to the log-odds of the labels.

Null texts and texts without words have no features, so that their score is the labels' mean.
Without labels of both kinds every score is 0.5. Rows are treated one by one: repeated rows give
repeated results, and an empty table an empty one. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .quality_rules import labelled_sample
from .words import Words, mix, span_hashes, text_slices

SAMPLE_DOCS = 4000
SAMPLE_WORDS = 4000
BITS = 18
DAMPING = 25.0

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x30:0x3A] = ord("0")


def _shapes(words: Words) -> np.ndarray:
    """A hash of each word's shape, in which runs of one class count once."""
    shape = _SHAPE[words.data]
    begins = np.zeros(len(shape), bool)
    begins[words.starts] = True
    kept = words.in_word.copy()
    kept[1:] &= (shape[1:] != shape[:-1]) | begins[1:]
    place = np.concatenate([[0], np.cumsum(kept)])
    return span_hashes(shape[kept], place[words.starts], place[words.ends])


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature indexes and the row of each occurrence."""
    doc, h, shape = words.doc, words.hashes(), _shapes(words)
    pair = doc[1:] == doc[:-1]
    a, b = h[:-1][pair], h[1:][pair]
    repeats = a == b
    keys = [h, a * np.uint64(3) + b * np.uint64(5) + np.uint64(1), shape + np.uint64(2),
            shape[:-1][pair] * np.uint64(7) + shape[1:][pair] * np.uint64(11) + np.uint64(3),
            repeats.astype(np.uint64) + np.uint64(4)]
    rows = [doc, doc[1:][pair], doc, doc[1:][pair], doc[1:][pair]]
    index = mix(np.concatenate(keys)) >> np.uint64(64 - BITS)
    return index.astype(np.int64), np.concatenate(rows)


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def scores(self, words: Words) -> np.ndarray:
        index, row = features(words)
        total = np.bincount(row, weights=self.weights[index], minlength=words.n)
        count = np.bincount(row, minlength=words.n) + DAMPING
        return 1 / (1 + np.exp(-np.clip(self.intercept + total / count, -30, 30)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], *, passes: int = 4,
          alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3) -> Model:
    """Follow the regularised leader, one example (indexes, counts, label) at a time.

    The intercept is the log-odds of the labels.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    good = sum(label for _, _, label in examples)
    intercept = float(np.log((good + 0.5) / (len(examples) - good + 0.5)))
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(examples)):
            at, count, label = examples[i]
            x = count / (count.sum() + DAMPING)
            w = weights(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(intercept + w @ x, -30, 30)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return Model(weights(z, n).astype(np.float32), intercept)


def fit(docs: DataFrame, labels: DataFrame, *, among=None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of a bounded sample of labelled documents; among: which ids may be learnt from."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "_text"):
                words = Words(part.column("_text"))
                index, row = features(words)
                key, count = np.unique((row << BITS) + index, return_counts=True)
                row, index = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
                bounds = np.searchsorted(row, np.arange(words.n + 1))
                fits = np.flatnonzero(words.counts <= SAMPLE_WORDS)
                cut = [slice(bounds[i], bounds[i + 1]) for i in fits]
                yield pa.RecordBatch.from_arrays([
                    part.column("_id").take(pa.array(fits)),
                    part.column("_label").take(pa.array(fits)).cast(pa.int64()),
                    pa.array([index[c].tobytes() for c in cut], pa.binary()),
                    pa.array([count[c].astype(np.float32).tobytes() for c in cut], pa.binary()),
                ], names=["id", "label", "index", "count"])

    kind = dict(labels.dtypes)[id_col]
    rows = labelled_sample(docs, labels, label_col, run,
                           f"id {kind}, label bigint, index binary, count binary", SAMPLE_DOCS,
                           id_col=id_col, text_col=text_col, among=among)
    examples = []
    for r in rows:
        examples.append((np.frombuffer(r["index"], np.int32).astype(np.int64),
                         np.frombuffer(r["count"], np.float32).astype(float), int(r.label > 0)))
    if len({label for _, _, label in examples}) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    return train(examples)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """id_col and score (0 to 1) of every document."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                found = model.scores(Words(part.column(text_col)))
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(found)],
                                                 names=[id_col, "score"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")
