"""Burrows-Wheeler transform of byte pieces, and common prefixes by breadth-first backward extension.

The pieces are one text, each ended by a separator of its own, so that nothing matches across
them. An interval holds the suffixes that begin with one string. Extending the string by a byte on
its left gives an interval again, found by the transform's backward step. Going through the
intervals breadth first, strings of length l are met in round l, and the border behind an extended
interval, if none was set there, lies between suffixes whose common prefix is just l bytes long.
The rounds stop at the least length asked for: a border that is still open then lies between
suffixes that share that many bytes or more.
"""

from __future__ import annotations

import numpy as np

_WORD = 6                    # bytes that the first sort compares, 9 bits each


def join_pieces(pieces: list[bytes]) -> np.ndarray:
    """Symbols: 0 for a separator, 1 to 256 for bytes."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    text = np.zeros(int(lengths.sum()) + len(pieces), np.int16)
    in_piece = np.ones(len(text), bool)
    in_piece[ends] = False
    text[in_piece] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int16) + 1
    return text


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each; a separator is below bytes and later ones."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(_WORD, np.int16)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    cut = np.zeros(n, bool)
    for i in range(_WORD):
        symbol = padded[i:i + n].copy()
        symbol[cut] = 0
        cut |= symbol == 0
        key = (key << 9) | symbol
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    # Suffixes that reach their separator are told apart by it, hence by position.
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | cut[order[1:]]
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    width = _WORD
    alone = new & np.append(new[1:], True)
    open_at = np.flatnonzero(~alone)
    while len(open_at):
        # Only suffixes whose place is not settled, by what follows the bytes compared so far.
        rows = order[open_at]
        keys = rank[rows] * (n + 1) + rank[np.minimum(rows + width, n - 1)]
        by = np.argsort(keys, kind="stable")
        keys, rows = keys[by], rows[by]
        order[open_at] = rows
        new = np.ones(len(rows), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        rank[rows] = np.repeat(open_at[first], np.diff(np.append(first, len(rows))))
        alone = new & np.append(new[1:], True)
        open_at = open_at[~alone]
        width *= 2
    return order, rank


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All places of the intervals, one interval after the other."""
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)


def open_borders(text: np.ndarray, order: np.ndarray, rank: np.ndarray, least: int) -> np.ndarray:
    """For each place, whether its suffix and the one before it share `least` bytes or more."""
    n = len(text)
    before = text[order - 1]                 # the transform; of the first suffix a separator
    back = rank[order - 1]                   # where a suffix goes when extended to its left
    before[order == 0] = 0
    is_open = np.ones(n + 1, bool)
    is_open[0] = is_open[n] = False
    head = text[order]
    starts = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (head[1:] == 0)]))
    is_open[starts] = False
    low, high = starts, np.append(starts[1:], n)
    for _ in range(1, least):
        if not len(low):
            break
        at = _ranges(low, high)
        symbol = before[at]
        held = symbol > 0
        at, symbol = at[held], symbol[held].astype(np.int64)
        interval = np.repeat(np.arange(len(low)), high - low)[held]
        # Of one interval and symbol, extended suffixes are neighbours in the same order.
        key = (interval << 9) | symbol
        if len(low) != len(key):
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
        if not len(at):
            break
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        low = back[at[first]]
        high = back[at[np.append(first[1:], len(at)) - 1]] + 1
        fresh = is_open[high]
        low, high = low[fresh], high[fresh]
        is_open[high] = False
    return is_open[:n]


def repeated_starts(pieces: list[bytes], least: int) -> np.ndarray:
    """For each symbol of the joined pieces, whether `least` bytes from there stand twice."""
    text = join_pieces(pieces)
    order, rank = suffix_array(text)
    shared = open_borders(text, order, rank, least)
    shared[:-1] |= shared[1:]
    found = np.zeros(len(text), bool)
    found[order[shared]] = True
    return found
