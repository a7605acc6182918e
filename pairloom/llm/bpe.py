"""BPE encoding and decoding of whole texts: speculate, verify, and merge only what fails.

For each distinct word the longest vocabulary entries are proposed from left to right. A proposal
is the encoding exactly if every two adjacent tokens, taken alone, encode to themselves. That test
runs for all pairs at once, as array operations over the merge table; words with a failing pair are
merged exactly, rank by rank. Encoded words are remembered in the Python worker, up to a
fixed count.

`encode` takes a null text as empty, and gives empty texts no tokens. Rows are treated one by one:
repeated rows give repeated results, and an empty table an empty one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .words import text_slices

# Latin text and general punctuation take a fast path; other characters are normalised and split
# by the tokenizer library itself, whose character tables may be of another Unicode version.
_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u203a\u20ac]")
_PYTHON_SPACE = re.compile("[\x1c-\x1f\x85\xa0]")
_SPACES = regex.compile(r"\p{White_Space}+")
_END = 256
_SYMBOLS = 257
_NEVER = np.int64(1) << 40
_REMEMBER = 150_000


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Lookup:
    """Values of 64-bit keys in arrays; `missing` for keys that are not there."""

    def __init__(self, values: dict[int, int], missing: int):
        self.keys = np.array(sorted(values), np.int64)
        self.values = np.array([values[k] for k in self.keys.tolist()] + [missing], np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != keys] = len(self.keys)
        return self.values[at]


def _first_of_runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


class WordBpe:
    """Encoder and decoder for a tokenizer file whose words end in a suffix.

    Supported is what such files hold: NFC, white space, lower case; a split pattern; byte
    symbols; merges; special tokens taken from the raw text. Other settings are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (steps != ["NFC", "Replace", "Lowercase"] or level["add_prefix_space"]
                or level["use_regex"] or split["behavior"] != "Removed" or not split["invert"]
                or model["dropout"] or model["byte_fallback"] or model["ignore_merges"]
                or model["continuing_subword_prefix"] or spec["decoder"]):
            raise ValueError(f"unsupported tokenizer settings in {path}")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.byte_of = {ord(c): b for b, c in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {text: np.uint32(i).tobytes() for text, i in special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        vocab: dict[str, int] = model["vocab"]
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.token = [""] * self.size
        for text, i in [*vocab.items(), *special.items()]:
            self.token[i] = text
        self._merges([m if isinstance(m, list) else m.split(" ") for m in model["merges"]], vocab)
        self._trie(vocab, model["end_of_word_suffix"])
        self.known: dict[str, bytes] = {}

    def _merges(self, pairs: list, vocab: dict[str, int]) -> None:
        """Ranks of merges, and for each token its parts and the rank of its merge."""
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        self.made = np.full(self.size, -1)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        ranks = {}
        for r, (a, b) in enumerate(pairs):
            a, b, made = vocab[a], vocab[b], self.merged[r]
            ranks[a * self.size + b] = r
            if self.made[made] < 0:
                self.left[made], self.right[made], self.made[made] = a, b, r
        self.rank = _Lookup(ranks, _NEVER)

    def _trie(self, vocab: dict[str, int], suffix: str) -> None:
        """Vocabulary entries by byte and end mark, less those that merging cannot produce."""
        tokens = np.flatnonzero(self.made >= 0)
        sound = self._compatible(self.left[tokens], self.right[tokens], self.made[tokens])
        unsound = set(tokens[~sound].tolist())
        step: dict[int, int] = {}
        accept = [-1]
        self.single = np.zeros((2, 256), np.int64)   # ids of one byte, inside and at the end
        for text, i in vocab.items():
            ends = text.endswith(suffix) and text != suffix
            body = text.removesuffix(suffix) if ends else text
            symbols = [self.byte_of[ord(c)] for c in body] + [_END] * ends
            if len(body) == 1:
                self.single[int(ends), symbols[0]] = i
            if i in unsound:
                continue
            node = 0
            for s in symbols:
                key = node * _SYMBOLS + s
                if key not in step:
                    step[key] = len(accept)
                    accept.append(-1)
                node = step[key]
            accept[node] = i
        self.step, self.accept = _Lookup(step, -1), np.array(accept, np.int64)

    def _compatible(self, a: np.ndarray, b: np.ndarray, own: np.ndarray | None = None):
        """Whether no merge crosses the border between tokens a and b before both are made.

        Undone step by step from the last merge: of the two pieces at the border the one made
        later gives way to its part next to the border. A merge of the two pieces of the moment
        crosses if it is due before the pieces that follow in time are made; at equal rank the
        left one of two overlapping merges goes first. own: ranks of merges that join a and b.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        limit = np.full(len(a), _NEVER) if own is None else own
        left_due, right_due = limit.copy(), limit.copy()
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            due = self.rank(x * self.size + y)
            bad = (due < left_due[live]) & (due <= right_due[live]) & (due != _NEVER)
            if own is not None:
                bad &= due != own[live]
            good[live[bad]] = False
            made_x, made_y = self.made[x], self.made[y]
            go_on = ~bad & ((made_x >= 0) | (made_y >= 0))
            undo_x = go_on & (made_x > made_y)
            undo_y = go_on & ~undo_x
            rows = live[undo_x]
            left_due[rows], a[rows] = made_x[undo_x], self.right[x[undo_x]]
            rows = live[undo_y]
            right_due[rows], b[rows] = made_y[undo_y], self.left[y[undo_y]]
            live = live[go_on]
        return good

    def _propose(self, symbols: np.ndarray, starts: np.ndarray):
        """Longest matches from left to right, all words a symbol at a time.

        Returns tokens with the word of each, in order, and the words where none fits.
        """
        word = np.arange(len(starts))
        at, node = starts.copy(), np.zeros(len(starts), np.int64)
        last_token, last_end = np.full(len(starts), -1), starts.copy()
        stop = np.append(starts[1:], len(symbols))
        tokens, words, places, failed = [], [], [], []
        while len(word):
            inside = at < stop[word]
            to = np.full(len(word), -1)
            to[inside] = self.step(node[inside] * _SYMBOLS + symbols[at[inside]])
            moved = to >= 0
            node[moved] = to[moved]
            at[moved] += 1
            # A token that leaves the end mark alone cannot be followed by another one.
            whole = at == stop[word]
            token = np.where(moved, self.accept[node], -1)
            fits = (token >= 0) & (whole | (symbols[np.minimum(at, len(symbols) - 1)] != _END))
            last_token[fits], last_end[fits] = token[fits], at[fits]
            stuck = ~moved
            none = stuck & (last_token < 0)
            failed.append(word[none])
            emit = stuck & ~none
            tokens.append(last_token[emit])
            words.append(word[emit])
            places.append(last_end[emit])
            at[emit], node[emit], last_token[emit] = last_end[emit], 0, -1
            live = ~none & ~(emit & (at == stop[word]))
            if not live.all():
                word, at, node = word[live], at[live], node[live]
                last_token, last_end = last_token[live], last_end[live]
        tokens, words = np.concatenate(tokens), np.concatenate(words)
        order = np.argsort(np.concatenate(places), kind="stable")
        return tokens[order], words[order], np.concatenate(failed)

    def _merge(self, parts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of whole words at once: in each, the pairs of its least rank.

        parts: one-byte tokens, word: the word of each. Equal pairs that overlap merge from the
        left. Words without a merge leave the loop.
        """
        done_parts, done_words = [], []
        rank = None
        while len(parts):
            if rank is None:
                rank = np.full(len(parts), _NEVER)   # of each part with the one after it
                inner = np.flatnonzero(word[1:] == word[:-1])
                rank[inner] = self.rank(parts[inner] * self.size + parts[inner + 1])
            first = _first_of_runs(word)
            counts = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            over = np.repeat(best == _NEVER, counts)
            if over.any():
                done_parts.append(parts[over])
                done_words.append(word[over])
                parts, word, rank = parts[~over], word[~over], rank[~over]
                continue
            hit = rank == np.repeat(best, counts)
            # Of touching hits, as in "aaaa", every other one from the left.
            begins = hit.copy()
            begins[1:] &= ~hit[:-1]
            at = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(begins, at, 0))
            merge = np.flatnonzero(hit & ((at - run_start) % 2 == 0))
            parts[merge] = self.merged[rank[merge]]
            keep = np.ones(len(parts), bool)
            keep[merge + 1] = False
            place = np.cumsum(keep) - 1
            parts, word, rank = parts[keep], word[keep], rank[keep]
            # Only pairs that hold a merged part have a new rank.
            new = place[merge]
            touched = np.zeros(len(parts), bool)
            touched[new] = True
            touched[new[new > 0] - 1] = True
            pairs = np.flatnonzero(touched)
            rank[pairs] = _NEVER
            pairs = pairs[pairs < len(parts) - 1]
            pairs = pairs[word[pairs] == word[pairs + 1]]
            rank[pairs] = self.rank(parts[pairs] * self.size + parts[pairs + 1])
        if not done_parts:
            return parts, word
        parts, word = np.concatenate(done_parts), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return parts[order], word[order]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of distinct, non-empty words of UTF-8 bytes: propose, verify, merge."""
        if not words:
            return []
        lengths = np.array([len(w) + 1 for w in words])
        stops = np.cumsum(lengths)
        symbols = np.full(stops[-1], _END)
        body = np.ones(len(symbols), bool)
        body[stops - 1] = False
        symbols[body] = np.frombuffer(b"".join(words), np.uint8)
        tokens, word, failed = self._propose(symbols, stops - lengths)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(tokens[inner] * self.size + tokens[inner + 1],
                                 return_inverse=True)
        good = self._compatible(pairs // self.size, pairs % self.size)[which]
        wrong = np.zeros(len(words), bool)
        wrong[failed] = True
        wrong[word[inner[~good]]] = True
        if wrong.any():
            owner = np.repeat(np.arange(len(words)), lengths)
            at = np.flatnonzero(body & wrong[owner])
            last = symbols[at + 1] == _END
            merged, merged_word = self._merge(self.single[last.astype(int), symbols[at]],
                                              owner[at])
            kept = ~wrong[word]
            tokens = np.concatenate([tokens[kept], merged])
            word = np.concatenate([word[kept], merged_word])
            order = np.argsort(word, kind="stable")
            tokens, word = tokens[order], word[order]
        raw = tokens.astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _normal(self, text: str) -> list[str]:
        """The runs between white space of the normalised text."""
        if not text.isascii():
            if _UNUSUAL.search(text):
                text = self.normalizer.normalize_str(text)
                return [run for run in text.split(" ") if run]
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
        text = text.lower()
        if _PYTHON_SPACE.search(text):
            return [run for run in _SPACES.split(text) if run]
        return text.split()

    def _pieces(self, run: str) -> list[bytes]:
        """The words of a run, in UTF-8."""
        if run.isascii() or not _UNUSUAL.search(run):
            if run.isalpha():
                return [run.encode()]
            if run[-1] in ".,;:!?" and run[:-1].isalpha():
                return [run[:-1].encode(), run[-1].encode()]
            return [p.encode() for p in self.pieces.findall(run)]
        return [bytes(map(self.byte_of.__getitem__, map(ord, piece)))
                for piece, _ in self.splitter.pre_tokenize_str(run)]

    def _learn(self, runs: set[str]) -> None:
        """Encode new runs and remember them."""
        new = [run for run in runs if run not in self.known]
        if not new:
            return
        pieces = list(map(self._pieces, new))
        distinct = list(set(chain.from_iterable(pieces)))
        ids = dict(zip(distinct, self.encode_words(distinct)))
        if len(self.known) + len(new) > _REMEMBER:
            self.known = {run: self.known[run] for run in runs if run in self.known}
        for run, parts in zip(new, pieces):
            self.known[run] = (ids[parts[0]] if len(parts) == 1
                               else b"".join([ids[p] for p in parts]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            if "<" in text and self.split_special.search(text):
                # Splitting on one group puts the special tokens at odd places.
                parts.append([[part] if i % 2 else self._normal(part)
                              for i, part in enumerate(self.split_special.split(text))])
            else:
                parts.append([self._normal(text)])
        runs: set[str] = set()
        for text in parts:
            runs.update(*text[::2])
        self._learn(runs)
        known, special = self.known, self.special
        return [b"".join([special[part[0]] if i % 2 else b"".join([known[run] for run in part])
                          for i, part in enumerate(text)]) for text in parts]

    def decode(self, ids: bytes) -> str:
        """The vocabulary's text of ids, special tokens included, as the file has no decoder."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


_BYTES_AT_ONCE = 2 << 20


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
           ids: bool = True, digests: bool = False) -> DataFrame:
    """One row per document: id_col, n_tokens, and ids (array), or digests, or both.

    digests: ids_sha256 of the ids as little-endian unsigned 32-bit integers, and decoded_sha256
    of the text that the ids decode to. path: a tokenizer file that every executor can read.
    """
    fields = [f"{id_col} {dict(docs.dtypes)[id_col]}", "n_tokens bigint"]
    fields += ["ids array<int>"] * ids + ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, text_col, _BYTES_AT_ONCE):
                found = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                columns = [part.column(0), pa.array([len(f) // 4 for f in found], pa.int64())]
                if ids:
                    flat = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
                    ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(flat)))
                if digests:
                    columns.append(pa.array([sha256(f).hexdigest() for f in found]))
                    columns.append(pa.array([sha256(bpe.decode(f).encode()).hexdigest()
                                             for f in found]))
                names = [f.split(" ")[0] for f in fields]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, ", ".join(fields))


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """One row per row of `encoded`: id_col and decoded, null ids giving an empty text."""
    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(np.array(i or [], "<u4").tobytes())
                     for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=[id_col, "decoded"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, ids_col).mapInArrow(run, f"{id_col} {kind}, decoded string")
