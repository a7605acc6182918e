"""Words of Arrow text batches, found with array operations over their UTF-8 bytes.

A word is a run of characters other than space and U+0009 to U+000D. Batches are handled in
slices of about a megabyte of text, so that memory does not depend on the batch size; a single
longer text is its own slice, and its hashes are taken block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
IN_WORD = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_KEYS = np.random.default_rng(20_240_105).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1 modulo 2 ** 64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        if size <= 2 * _BLOCK_BYTES:
            _powers[base] = table
    return table[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are ascending and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK_BYTES, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        sums = np.empty(high - low + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_KEYS[data[low:high]] * _power_table(_BASE, high - low), out=sums[1:])
        begin, end = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[end] - sums[begin]) * _power_table(_INVERSE, high - low + 1)[begin]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


class Words:
    """Words of the texts of one slice; a null text counts as empty."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        self.data = data[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.n = len(texts)
        self.in_word = IN_WORD[self.data]
        begin, end = self.in_word.copy(), self.in_word.copy()
        begin[1:] &= ~self.in_word[:-1]
        end[:-1] &= ~self.in_word[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        begin[cuts] = self.in_word[cuts]
        end[cuts - 1] = self.in_word[cuts - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        bounds = np.searchsorted(self.starts, self.offsets)
        self.first = bounds[:-1]
        self.counts = np.diff(bounds)

    @cached_property
    def doc(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; lower: with A-Z as a-z."""
        return span_hashes(LOWER[self.data] if lower else self.data, self.starts, self.ends)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sums by row of one value for each byte of the slice."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(sums[self.offsets])

    def per_doc_words(self, values: np.ndarray) -> np.ndarray:
        """Sums by row of one value for each word."""
        return np.bincount(self.doc, weights=values, minlength=self.n)


def text_slices(batch: pa.RecordBatch, column: str,
                size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `size` bytes of text, of one row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        used = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, used + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def word_ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs that lie within one row, and where they start."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = len(hashes) - n + 1
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k:k + size]
    at = np.flatnonzero(doc[:size] == doc[n - 1:])
    return mix(out[at]), at
