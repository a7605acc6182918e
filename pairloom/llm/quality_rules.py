"""Quality rules: fixed counts of a text, and a linear-chain CRF that labels its lines.

The CRF marks each line with a word as content or boilerplate by Viterbi decoding; a document is
kept if content lines hold at least half of its words. Its weights are fitted by gradient ascent
on the lines of a bounded sample of labelled documents (`SAMPLE_DOCS` documents of at most
`SAMPLE_LINES` lines each), whose lines take their document's label. Without two kinds of labels
there is no model, and the fixed rules decide alone.

A null text has no words; texts without words fail the base rules. Rows are treated one by one:
repeated rows give repeated results, and an empty table an empty one. Only the named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import LOWER, Words, span_hashes, text_slices, word_ngrams

SAMPLE_DOCS = 3000
SAMPLE_LINES = 400

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
CONTENT_SHARE = 0.5

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = LOWER != np.arange(256)
_DIGIT = (np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)
_MARKS = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".!?:;\"')]", np.uint8))
_WINDOW = 8


class Lines(Words):
    """Words and \\n-split lines of the texts of one slice."""

    def __init__(self, texts):
        super().__init__(texts)
        self.word_hashes = self.hashes()
        breaks = np.flatnonzero(self.data == 0x0A)
        row = np.searchsorted(self.offsets, breaks, side="right") - 1
        rows = np.concatenate([np.arange(self.n), row])
        begins = np.concatenate([self.offsets[:-1], breaks + 1])
        order = np.lexsort((begins, rows))
        self.line_row, self.line_start = rows[order], begins[order]
        last = np.append(self.line_row[1:] != self.line_row[:-1], True)[:len(self.line_row)]
        following = np.append(self.line_start[1:] - 1, 0)[:len(self.line_start)]
        self.line_end = np.where(last, self.offsets[1:][self.line_row], following)
        first = np.searchsorted(self.starts, self.line_start)
        self.line_words = np.searchsorted(self.starts, self.line_end) - first
        # From here on only lines with a word.
        used = self.line_words > 0
        self.line_row, self.line_start = self.line_row[used], self.line_start[used]
        self.line_end, self.line_words = self.line_end[used], self.line_words[used]
        self.line_of = np.repeat(np.arange(len(self.line_row)), self.line_words)
        self.repeats = self._repeats()

    def _repeats(self) -> np.ndarray:
        """Whether a line equals an earlier one of its text."""
        keys = span_hashes(self.data, self.line_start, self.line_end)
        order = np.lexsort((np.arange(len(keys)), keys, self.line_row))
        same = np.zeros(len(keys), bool)
        same[order[1:]] = ((keys[order[1:]] == keys[order[:-1]])
                           & (self.line_row[order[1:]] == self.line_row[order[:-1]]))
        return same

    def repeated_words(self) -> np.ndarray:
        """Words, by row, in word windows that the text holds twice or more."""
        keys, at = word_ngrams(self.word_hashes, self.doc, _WINDOW)
        row = self.doc[at]
        order = np.lexsort((keys, row))
        same = (keys[order[1:]] == keys[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edges = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(edges, at[twice], 1)
        np.add.at(edges, at[twice] + _WINDOW, -1)
        return self.per_doc_words(np.cumsum(edges[:-1]) > 0).astype(np.int64)

    def base(self) -> dict[str, np.ndarray]:
        """The fixed counts by row."""
        characters = self.in_word & ((self.data & 0xC0) != 0x80)
        return {
            "n_words": self.counts.astype(np.int64),
            "word_chars": self.per_doc(characters),
            "n_symbols": self.per_doc(_SYMBOLS[self.data]),
            "n_dup_lines": np.bincount(self.line_row[self.repeats], minlength=self.n),
            "n_repeat_words": self.repeated_words(),
        }

    def _in_lines(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[self.line_end] - sums[self.line_start]).astype(float)

    def _of_words(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.line_of, weights=flags, minlength=len(self.line_row))

    def features(self) -> np.ndarray:
        """Observations of each line with a word, 0 or 1."""
        words = self.line_words.astype(float)
        length = self._in_lines(self.in_word) / words
        symbols = self._in_lines(_SYMBOLS[self.data]) / words
        marks = self._in_lines(_MARKS[self.data]) / words
        upper = self._in_lines(_UPPER[self.data]) / (words * length)
        digits = self._in_lines(_DIGIT[self.data]) / (words * length)
        again = np.zeros(len(self.starts))
        again[1:] = ((self.word_hashes[1:] == self.word_hashes[:-1])
                     & (self.line_of[1:] == self.line_of[:-1]))
        same = self._of_words(again) / words
        single = self._of_words(self.ends - self.starts == 1) / words
        last_word = np.cumsum(self.line_words) - 1
        closed = _CLOSING[self.data[self.ends[last_word] - 1]]
        return np.stack([
            np.ones(len(words)),
            symbols > 0.1, symbols > 0.5, symbols > 1.5,
            marks > 0.3, marks > 0.8,
            upper > 0.3, upper > 0.7,
            digits > 0.1, digits > 0.3,
            same > 0.1, same > 0.5,
            single > 0.2, single > 0.4,
            words < 3, words < 6, words > 50,
            length < 3, length > 9, length > 14,
            closed, self.repeats,
        ], axis=1).astype(np.uint8)


class LineCrf:
    """A linear chain over lines with the states boilerplate (0) and content (1)."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    @staticmethod
    def _padded(rows: np.ndarray, values: np.ndarray, n: int):
        """Values of ascending rows as an array by row and place, and what of it is filled."""
        counts = np.bincount(rows, minlength=n)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        out = np.zeros((n, max(1, counts.max(initial=1)), *values.shape[1:]))
        filled = np.zeros(out.shape[:2], bool)
        out[rows, place], filled[rows, place] = values, True
        return out, filled, place

    @classmethod
    def fit(cls, chains: list[np.ndarray], labels: list[int], *, rounds: int = 120,
            rate: float = 0.3, decay: float = 1e-3) -> LineCrf:
        """Penalised likelihood by AdaGrad over all chains. A chain holds the features of lines."""
        order = np.argsort([-len(c) for c in chains], kind="stable")
        lengths = np.array([len(chains[i]) for i in order])
        states = np.asarray(labels)[order]
        # Lines by place, then chain: the chains that reach a place are the first ones.
        live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(lengths[0])]
        begins = np.cumsum([0, *live])
        x = np.empty((begins[-1], chains[0].shape[1]), np.float32)
        for row, i in enumerate(order):
            x[begins[:lengths[row]] + row] = chains[i]
        truth = np.concatenate([states[:n] for n in live])
        lines = len(truth)
        seen_emit = np.stack([x[truth == s].sum(0) for s in (0, 1)], axis=1)
        seen_step = np.diag([(lengths[states == s] - 1).sum() for s in (0, 1)]).astype(float)
        emit, step = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
        emit_sq, step_sq = np.full_like(emit, 1e-6), np.full_like(step, 1e-6)
        for _ in range(rounds):
            marginal, pair = cls._expected(x @ emit, step, live, begins)
            grad_emit = (seen_emit - x.T @ marginal) / lines - decay * emit
            grad_step = (seen_step - pair) / lines - decay * step
            emit_sq += grad_emit ** 2
            step_sq += grad_step ** 2
            emit += rate * grad_emit / np.sqrt(emit_sq)
            step += rate * grad_step / np.sqrt(step_sq)
        return cls(emit, step)

    @staticmethod
    def _expected(scores, step, live, begins):
        """Posterior state probabilities by line, and expected transitions, by forward-backward."""
        weight = np.exp(scores - scores.max(1, keepdims=True))
        move = np.exp(step)
        forward, scale = np.empty_like(weight), np.empty(len(weight))
        for t, n in enumerate(live):
            at = slice(begins[t], begins[t] + n)
            here = weight[at]
            if t:
                here = here * (forward[begins[t - 1]:begins[t - 1] + n] @ move)
            scale[at] = here.sum(1)
            forward[at] = here / scale[at, None]
        backward, pair = np.ones_like(weight), np.zeros((2, 2))
        for t in range(len(live) - 1, 0, -1):
            n, at = live[t], slice(begins[t], begins[t] + live[t])
            before = slice(begins[t - 1], begins[t - 1] + n)
            ahead = weight[at] * backward[at] / scale[at, None]
            backward[before] = ahead @ move.T
            pair += move * (forward[before].T @ ahead)
        return forward * backward, pair

    def viterbi(self, features: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """The best state of each line; rows: the ascending text of each, of n texts."""
        if not len(rows):
            return np.empty(0, np.int64)
        # Texts of like length go together, so that one long text does not pad all others.
        counts = np.bincount(rows, minlength=n)
        states = np.empty(len(rows), np.int64)
        begins = np.cumsum(counts) - counts
        scores = features.astype(float) @ self.emit
        for size in np.unique(np.ceil(np.log2(np.maximum(counts, 1)))):
            texts = np.flatnonzero((np.ceil(np.log2(np.maximum(counts, 1))) == size)
                                   & (counts > 0))
            if not len(texts):
                continue
            lengths = counts[texts]
            row = np.repeat(np.arange(len(texts)), lengths)
            at = np.repeat(begins[texts] - (np.cumsum(lengths) - lengths), lengths)
            at = at + np.arange(lengths.sum())
            padded, filled, place = self._padded(row, scores[at], len(texts))
            states[at] = self._best(padded, filled)[row, place]
        return states

    def _best(self, scores, filled):
        n, length, _ = scores.shape
        back = np.zeros((n, length, 2), np.int8)
        best = scores[:, 0].copy()
        for t in range(1, length):
            options = best[:, :, None] + self.step
            back[:, t] = options.argmax(1)
            moved = options.max(1) + scores[:, t]
            best = np.where(filled[:, t, None], moved, best)
        out = np.zeros((n, length), np.int64)
        state = best.argmax(1)
        rows = np.arange(n)
        for t in range(length - 1, -1, -1):
            out[:, t] = state
            state = np.where(filled[:, t], back[rows, t, state], state)
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, run, schema: str,
                    size: int, *, id_col: str = "doc_id", text_col: str = "text",
                    among=None) -> list:
    """Rows that `run` makes of (id, text, label) for at most `size` labelled documents.

    The documents of least id hash are taken, from labels whose id and label are not null; among:
    a further condition on labels. run gets and gives Arrow batches; the first column of `schema`
    is the id. Repeated ids and contradicting labels count as rows of their own; as one id may be
    held by very many rows, the number of rows is bounded again after the join.
    """
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).dropna()
    if among is not None:
        marked = marked.where(among(F.col("_id")))
    chosen = marked.distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(size)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    made = texts.join(F.broadcast(chosen), "_id").select("_id", "_text", "_label").mapInArrow(
        run, schema)
    return made.orderBy(F.xxhash64(F.col(made.columns[0])), *made.columns[:2]).limit(size).collect()


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> LineCrf | None:
    """The CRF of a bounded sample of labelled documents; None without labels of both kinds."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "_text"):
                lines = Lines(part.column("_text"))
                features = lines.features()
                counts = np.bincount(lines.line_row, minlength=lines.n)
                ends = np.cumsum(counts)
                fits = np.flatnonzero((counts > 0) & (counts <= SAMPLE_LINES))
                yield pa.RecordBatch.from_arrays([
                    part.column("_id").take(pa.array(fits)),
                    part.column("_label").take(pa.array(fits)).cast(pa.int64()),
                    pa.array([features[ends[i] - counts[i]:ends[i]].tobytes() for i in fits],
                             pa.binary())], names=["id", "label", "features"])

    kind = dict(labels.dtypes)[id_col]
    rows = labelled_sample(docs, labels, label_col, run,
                           f"id {kind}, label bigint, features binary", SAMPLE_DOCS,
                           id_col=id_col, text_col=text_col)
    width = Lines(pa.array(["a"])).features().shape[1]
    chains = [np.frombuffer(r.features, np.uint8).reshape(-1, width) for r in rows]
    states = [int(r.label > 0) for r in rows]
    return LineCrf.fit(chains, states) if len(set(states)) == 2 else None


def verdicts(texts: pa.Array, model: LineCrf | None) -> dict[str, np.ndarray]:
    """The columns of `judge` for the texts of one slice."""
    lines = Lines(texts)
    out = lines.base()
    words, repeated = out["n_words"], out["n_repeat_words"]
    failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)
    share = np.ones(lines.n)
    if model is not None:
        content = model.viterbi(lines.features(), lines.line_row, lines.n)
        held = np.bincount(lines.line_row, weights=lines.line_words * content, minlength=lines.n)
        share = np.where(words > 0, held / np.maximum(words, 1), 0.0)
    return {**out, "content_share": share, "base_failed": failed,
            "kept": ~failed & (share >= CONTENT_SHARE)}


def judge(docs: DataFrame, model: LineCrf | None, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document with its counts, content share and verdict."""
    fields = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
              "n_dup_lines": "bigint", "n_repeat_words": "bigint", "content_share": "double",
              "base_failed": "boolean", "kept": "boolean"}

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                found = verdicts(part.column(text_col), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), *(pa.array(found[f]) for f in fields)],
                    names=[id_col, *fields])

    kind = dict(docs.dtypes)[id_col]
    schema = ", ".join([f"{id_col} {kind}", *(f"{f} {t}" for f, t in fields.items())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def keep(docs: DataFrame, model: LineCrf | None, *, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that `judge` keeps."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                yield part.filter(pa.array(verdicts(part.column(text_col), model)["kept"]))

    return docs.mapInArrow(run, docs.schema)
