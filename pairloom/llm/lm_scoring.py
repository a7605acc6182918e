"""Language-model scores of whole texts: add-one unigrams, and a gated recurrent network.

Tokens are words with A-Z in lower case, then one end token. Counts are taken over every token of
the training documents, held as 64-bit hashes. The network (`gru`) knows every token whose count
goes to the tasks (`HEAD`) and one id for all others; another token's probability is that id's
times its add-one share of the counts outside the network's vocabulary. So the score is the
log10 probability of the complete text, for any words.

The network learns one pass over all training texts: every task learns on its own part of the
table (`TASK_TOKENS` tokens or more, so that the weights sent stay in proportion to the input, not
to its partitions) from the same start, by truncated backpropagation with the state carried through
each whole text, and what each block of weights has moved by is averaged by tokens over the tasks that moved
it. Scores carry the state through the whole text.

Counts of a bounded number of frequent tokens (`HEAD`) go to every task; the others are joined
by hash in a shuffle that can split a hot token. A null or empty text has the end token alone. A null
id is a training document's. Repeated rows count and score each on their own; an empty table
gives an empty result, and without training documents the counts are zero. Other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.scratch import scratch_dir

from . import gru
from .words import Words, text_slices

HEAD = 1 << 17
END = np.uint64(0x9E3779B97F4A7C55)      # stands for the end token among word hashes
_HELD = 1 << 21
_STEPS = 4                               # steps of frequency in a doubling
_SCALE = 1 << 20                         # weights are summed as whole numbers, in any order alike
_MOST = 32                               # that a weight moves by
_UNIT = 1 << 12                          # of tokens, in averages: sums of 10^13 tokens fit
_BLOCK = 1 << 10                         # weights to a row
_SLICE_BYTES = 4 << 20
TASK_TOKENS = 8 << 20                    # that a task learns from: each sends a whole model


def token_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts of a slice, and how many each text has."""
    counts = words.counts + 1
    out = np.full(counts.sum(), END)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts) - 1] = False
    out[inside] = words.hashes(lower=True)
    return out, counts


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """token (hash) and count over all texts, summed up in tasks before the shuffle."""
    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys)
        keys, values = keys[order], np.concatenate([v for _, v in parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(values, first)

    def batch(keys, values):
        return pa.RecordBatch.from_arrays([_signed(keys), pa.array(values)],
                                          names=["token", "n"])

    def run(batches):
        parts, held = [], 0
        for rows in batches:
            for part in text_slices(rows, text_col):
                hashes, _ = token_hashes(Words(part.column(text_col)))
                parts.append(np.unique(hashes, return_counts=True))
                held += len(parts[-1][0])
                if held > _HELD:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > _HELD // 2:
                        yield batch(*parts[0])
                        parts, held = [], 0
        if parts:
            yield batch(*merged(parts))

    return (docs.select(text_col).mapInArrow(run, "token bigint, n bigint")
            .groupBy("token").agg(F.sum("n").alias("count")))


@dataclass
class Model:
    """What every task needs: totals, counts of frequent tokens, ids of the network's tokens."""

    total: int
    distinct: int
    head: np.ndarray            # ascending hashes
    head_counts: np.ndarray
    ids: np.ndarray             # the network's id of each: its rank
    other_total: int            # counts of tokens that the network does not know
    other_distinct: int
    params: gru.Params | None = None

    @property
    def other(self) -> int:
        """The network's id of all tokens that are not in the head."""
        return len(self.head)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Network ids, and counts (-1: not in the head)."""
        if not len(self.head):
            return np.full(len(hashes), self.other), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        found = self.head[at] == hashes
        return (np.where(found, self.ids[at], self.other),
                np.where(found, self.head_counts[at], -1))


def _summary(counts: DataFrame) -> Model:
    """Totals and the head: the frequency steps that together hold at most HEAD tokens."""
    step = F.floor(F.log2(F.col("count").cast("double")) * _STEPS).alias("step")
    rows = counts.groupBy(step).agg(F.count("*").alias("n"), F.sum("count").alias("sum")).collect()
    total, distinct = sum(r["sum"] for r in rows), sum(r.n for r in rows)
    held, least = 0, None
    for r in sorted(rows, key=lambda r: -r.step):
        held += r.n
        if held > HEAD:
            break
        least = r.step
    head = [] if least is None else counts.where(step >= least).collect()
    hashes = np.array([r.token for r in head], np.int64).view(np.uint64)
    values = np.array([r["count"] for r in head], np.int64)
    order = np.argsort(hashes)
    hashes, values = hashes[order], values[order]
    # Ids go from the most frequent token on; ties by hash.
    ids = np.empty(len(hashes), np.int64)
    ids[np.lexsort((hashes, -values))] = np.arange(len(hashes))
    return Model(total, distinct, hashes, values, ids,
                 total - int(values.sum()), distinct - len(values))


def _trained(docs: DataFrame, model: Model, text_col: str) -> gru.Params:
    """Weights moved as the tasks' own have on average, each in one pass over its texts."""
    counts = np.empty(len(model.head) + 1)
    counts[model.ids], counts[model.other] = model.head_counts, model.other_total
    start = gru.initial(counts)

    def rows(places, weights, blocks):
        return pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(weights, pa.int64()),
             pa.array([b.tobytes() for b in blocks], pa.binary())],
            names=["place", "weight", "moved"])

    def run(batches):
        trainer = gru.Trainer(start)
        for batch in batches:
            for part in text_slices(batch, text_col):
                hashes, sizes = token_hashes(Words(part.column(text_col)))
                starts = np.zeros(len(hashes), bool)
                starts[np.cumsum(sizes) - sizes] = True
                trainer.feed(model.lookup(hashes)[0], starts)
        trainer.feed(np.empty(0, np.int64), np.empty(0, bool), last=True)
        if trainer.tokens:
            moved = np.clip(gru.flat(trainer.p) - gru.flat(start), -_MOST, _MOST)
            moved = np.rint(moved * _SCALE).astype(np.int32)
            moved = np.pad(moved, (0, -len(moved) % _BLOCK)).reshape(-1, _BLOCK)
            places = np.flatnonzero(moved.any(axis=1))
            weight = max(1, trainer.tokens // _UNIT)
            for i in range(0, len(places), 256):
                at = places[i:i + 256]
                yield rows(at, np.full(len(at), weight), moved[at])

    def averaged(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for place, weight, moved in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held = sums.setdefault(place, [0, np.zeros(_BLOCK, np.int64)])
                held[0] += weight
                held[1] += np.frombuffer(moved, np.int32).astype(np.int64) * weight
        for place, (weight, total) in sums.items():
            yield rows([place], [weight], [np.rint(total / weight).astype(np.int32)])

    kind = "place bigint, weight bigint, moved binary"
    tasks = -(-model.total // TASK_TOKENS)
    found = (docs.select(text_col).coalesce(max(1, tasks)).mapInArrow(run, kind).repartition("place")
             .mapInArrow(averaged, kind).select("place", "moved").collect())
    out = gru.flat(start)
    for r in found:
        at = r.place * _BLOCK
        block = np.frombuffer(r.moved, np.int32)[:len(out) - at]
        out[at:at + _BLOCK] += block.astype(np.float32) / _SCALE
    return gru.unflat(start, out)


def fit(docs: DataFrame, is_training: Column, folder: str, *, text_col: str = "text") -> Model:
    """Counts of the training documents, stored below `folder`, and the model learnt from them."""
    training = docs.where(is_training)
    token_counts(training, text_col).write.parquet(f"{folder}/counts")
    model = _summary(docs.sparkSession.read.parquet(f"{folder}/counts"))
    model.params = _trained(training, model, text_col)
    return model


def score(docs: DataFrame, model: Model, folder: str, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    log_ten = np.log(10.0)

    def run(batches):
        # Numbers that no other task gives; the rows are stored before they are used.
        uid = TaskContext.get().partitionId() << 40
        for rows in batches:
            for part in text_slices(rows, text_col, _SLICE_BYTES):
                hashes, sizes = token_hashes(Words(part.column(text_col)))
                ids, counts = model.lookup(hashes)
                row = np.repeat(np.arange(len(sizes)), sizes)
                in_head = counts >= 0
                log_count = np.where(in_head, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
                other = ids == model.other
                network = gru.score(model.params, ids, sizes) / log_ten
                network += np.where(other, log_count - np.log10(
                    model.other_total + model.other_distinct + 1.0), 0.0)

                def by_row(values):
                    return np.bincount(row, weights=values, minlength=len(sizes))
                tail = np.concatenate([[0], np.cumsum(np.bincount(
                    row[~in_head], minlength=len(sizes)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid + np.arange(len(sizes))), part.column(id_col),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(by_row(in_head).astype(np.int64)),
                    pa.array(by_row(log_count) - sizes * np.log10(
                        model.total + model.distinct + 1.0)),
                    pa.array(by_row(network)),
                    pa.ListArray.from_arrays(tail, _signed(hashes[~in_head])),
                ], names=["uid", id_col, "n_tokens", "n_known", "base_score", "score", "tail"])
                uid += len(sizes)

    kind = dict(docs.dtypes)[id_col]
    docs.select(id_col, text_col).mapInArrow(
        run, f"uid bigint, {id_col} {kind}, n_tokens bigint, n_known bigint, base_score double, "
             "score double, tail array<bigint>").write.parquet(f"{folder}/scores")
    scores = spark.read.parquet(f"{folder}/scores")
    counts = spark.read.parquet(f"{folder}/counts")
    tail = scores.select("uid", F.explode("tail").alias("token"))
    known = tail.join(counts, "token").groupBy("uid").agg(
        F.count("*").alias("known"), F.sum(F.log10(F.col("count") + 1.0)).alias("log_count"))
    more, log_count = (F.coalesce(c, F.lit(0)) for c in ("known", "log_count"))
    return scores.drop("tail").join(known, "uid", "left").select(
        id_col, "n_tokens", (F.col("n_known") + more).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + log_count).alias("base_score"),
        (F.col("score") + log_count).alias("score"))


def score_held_out(docs: DataFrame, is_training: Column, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Scores of all documents under the model of the training ones."""
    folder = scratch_dir(docs.sparkSession, "lm")
    return score(docs, fit(docs, is_training, folder, text_col=text_col), folder,
                 id_col=id_col, text_col=text_col)
