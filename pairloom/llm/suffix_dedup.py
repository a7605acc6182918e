"""Bytes that stand in a string of `least` bytes which also starts anywhere else.

What repeats is found on Burrows-Wheeler transforms (`bwt`), which need their text in one place. So
texts are cut into pieces that may share something first. The strings of `least` bytes that start in
a text, its windows, are named by the least hash of the shorter strings in them. Equal windows have
the same name, wherever they are. Consecutive windows of one name are a piece, at most `RUN` of
them; pieces whose name occurs once hold nothing that repeats. Of equal pieces, which repeat all
through, one is compared with the other pieces of its name; pieces are dealt by name to shards of
`SHARD_BYTES`, and each shard has a transform of its own. A name of more than `LARGE` different
pieces is not sent to one shard: its pieces are cut again by longer strings, so that what they share
becomes equal pieces. Where even these are too many for a shard, windows are named by all their
bytes, and those that occur twice repeat. Nothing is left out either way.

Texts are compared as UTF-8 bytes, null as empty, and matches never cross texts. Rows with the same
text get the same result, also if they are equal in all columns; ids are only carried along and may
be null or repeat. Texts below `least` bytes, and an empty table, lose nothing. Very long texts are
read in blocks of `_BLOCK` windows. Only the id and the text column are read by `find`; `remove`
keeps all others, whatever their names. Names are 64-bit hashes, and agree by chance only to give a
shard more to compare. Equal pieces are told by 128 bits, name and hash, and texts by an md5 digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.scratch import remove as remove_folder, scratch_dir

from .bwt import repeated_starts
from .jaccard_join import text_key
from .words import _BASE, _BYTE_KEYS, _INVERSE, _power_table, mix, text_slices

LEAST = 400
RUN = 2048
LARGE = 1024
SHARD_BYTES = 1 << 20
_BLOCK = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    size, done = len(values) - width + 1, 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:size], values[width - done:width - done + size])


class Pieces:
    """The pieces of some byte strings: those of `data` between `offsets`."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int, tenths: int = 4):
        short = max(1, least * tenths // 10)
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_KEYS[data] * _power_table(_BASE, n), out=sums[1:])
        inverse = _power_table(_INVERSE, n + 1)
        hashes = mix((sums[short:] - sums[:-short]) * inverse[:n - short + 1])
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        at = (_sliding_min(keys, least - short + 1) & _PLACE).astype(np.int64)
        # Windows that lie within one string.
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
        window = np.flatnonzero(np.arange(len(at)) + least <= offsets[1:][text])
        text, at = text[window], at[window]
        names = hashes[at]
        new = np.ones(len(window), bool)
        new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        place = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        new |= place % RUN == 0
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        begin, end = window[first[:len(last)]], window[last[:len(first)]] + least
        self.text = text[first]
        self.starts = begin - offsets[:-1][self.text]
        self.sizes = end - begin
        self.names = names[first]
        self.hashes = mix((sums[end] - sums[begin]) * inverse[begin] + self.sizes.astype(np.uint64))
        # A window can stand twice in one piece only if the place of its name changes.
        moved = np.concatenate([[0], np.cumsum(at[1:] != at[:-1])]) if len(at) else at
        self.twice = moved[last] != moved[first]


_PIECE = "name bigint, hash bigint, key binary, start bigint, size bigint, twice boolean"


def _piece_rows(pieces: Pieces, names: np.ndarray, keys: pa.Array, starts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(names.view(np.int64)), pa.array(pieces.hashes.view(np.int64)), keys,
         pa.array(starts), pa.array(pieces.sizes), pa.array(pieces.twice)],
        names=["name", "hash", "key", "start", "size", "twice"])


def _windows(data: np.ndarray, least: int) -> np.ndarray:
    """A hash of every `least` bytes of a string."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * _power_table(_BASE, n), out=sums[1:])
    return mix((sums[least:] - sums[:-least]) * _power_table(_INVERSE, n + 1)[:n - least + 1])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts that are not null, and where each begins and ends."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _blocks(data: np.ndarray, offsets: np.ndarray,
            least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Strings, their offsets, rows and first bytes: all texts at once, or a long one in blocks."""
    if len(offsets) > 2 or len(data) < 2 * _BLOCK:
        yield data, offsets, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
        return
    for base in range(0, len(data) - least + 1, _BLOCK):
        block = data[base:base + _BLOCK + least - 1]
        yield block, np.array([0, len(block)]), np.zeros(1, np.int64), np.array([base])


def _all_pieces(docs: DataFrame, least: int) -> DataFrame:
    """All pieces of the frame's texts (key, text)."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                keys = part.column("key")
                for data, offsets, rows, base in _blocks(*_bytes(part.column("text")), least):
                    if len(data) < least:
                        continue
                    pieces = Pieces(data, offsets, least)
                    yield _piece_rows(pieces, pieces.names,
                                      keys.take(pa.array(rows[pieces.text])),
                                      base[pieces.text] + pieces.starts)

    return docs.mapInArrow(run, _PIECE)


def _smaller_pieces(pieces: DataFrame, least: int) -> DataFrame:
    """Pieces (name, key, start, piece) cut again, by longer strings; their names hold both."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "piece"):
                names = part.column("name").to_numpy().view(np.uint64)
                starts = part.column("start").to_numpy()
                smaller = Pieces(*_bytes(part.column("piece")), least, tenths=9)
                yield _piece_rows(smaller, mix(names[smaller.text] ^ smaller.names),
                                  part.column("key").take(pa.array(smaller.text)),
                                  starts[smaller.text] + smaller.starts)

    return pieces.select("name", "key", "start", "piece").mapInArrow(run, _PIECE)


def _cut(touched: DataFrame, large: bool) -> DataFrame:
    """The wanted pieces of the texts: name, key, start, alone, piece."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                for key, text, needs in zip(*(part.column(c) for c in ("key", "text", "needs"))):
                    raw = text.as_py().encode()
                    rows = [n for n in needs.as_py() if n["large"] == large]
                    for i in range(0, len(rows), 4096):
                        some = rows[i:i + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([n["name"] for n in some], pa.int64()),
                             pa.array([key.as_py()] * len(some), pa.binary()),
                             pa.array([n["start"] for n in some], pa.int64()),
                             pa.array([n["alone"] for n in some], pa.bool_()),
                             pa.array([raw[n["start"]:n["start"] + n["size"]] for n in some],
                                      pa.binary())],
                            names=["name", "key", "start", "alone", "piece"])

    has = F.exists("needs", lambda n: n["large"] == F.lit(large))
    return touched.where(has).select("key", "text", "needs").mapInArrow(
        run, "name bigint, key binary, start bigint, alone boolean, piece binary")


_SPAN = "key binary, start bigint, stop bigint"


def _compare(pieces: DataFrame, shards: int, least: int) -> DataFrame:
    """Spans of the pieces' windows that stand twice in their shard."""
    def run(table: pa.Table) -> pa.Table:
        texts = table.column("piece").to_pylist()
        found = repeated_starts(texts, least)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        # Copies of a piece are known to repeat; it is here to be met by others.
        found &= np.repeat(table.column("alone").to_numpy(), lengths)
        edge = np.diff(np.concatenate([[0], found.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.cumsum(lengths) - lengths
        row = np.searchsorted(offsets, begin, side="right") - 1
        start = table.column("start").to_numpy()[row] - offsets[row]
        return pa.table({"key": table.column("key").take(pa.array(row)),
                         "start": start + begin, "stop": start + end - 1 + least})

    shard = F.pmod(F.xxhash64("name"), F.lit(shards)).alias("shard")
    return pieces.select(shard, "key", "start", "alone", "piece").groupBy("shard").applyInArrow(
        run, _SPAN)


def _each_window(pieces: DataFrame, least: int) -> DataFrame:
    """name, hash, key, start of every window of the pieces."""
    def run(batches):
        for batch in batches:
            for name, key, start, _, piece in zip(*batch.columns):
                hashes = _windows(np.frombuffer(piece.as_py(), np.uint8), least)
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, name.as_py())), pa.array(hashes.view(np.int64)),
                     pa.array([key.as_py()] * n, pa.binary()),
                     pa.array(start.as_py() + np.arange(n))],
                    names=["name", "hash", "key", "start"])

    return pieces.mapInArrow(run, "name bigint, hash bigint, key binary, start bigint")


class _Search:
    def __init__(self, docs: DataFrame, text_col: str, least: int, shard_bytes: int, large: int):
        self.spark = docs.sparkSession
        self.least, self.shard_bytes, self.large = least, shard_bytes, large
        text = F.coalesce(F.col(text_col), F.lit(""))
        self.docs = docs.select(text_key(text).alias("key"), text.alias("text")).where(
            F.octet_length("text") >= least)
        self.folder = scratch_dir(self.spark, "suffixes")

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        """Written and read, so that both sides of a join have shuffles that can be split."""
        frame.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def level(self, pieces: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Pieces of names that may repeat; of these, one of each to compare; spans of copies."""
        pieces = self.store(pieces, f"pieces{name}")
        names = self.store(pieces.groupBy("name").agg(
            F.count("*").alias("n"), F.max("twice").alias("twice")).where(
                "n > 1 or twice").select("name"), f"names{name}")
        shared = self.store(pieces.join(names, "name"), f"shared{name}")
        remove_folder(self.spark, f"{self.folder}/pieces{name}")
        kinds = self.store(shared.groupBy("name", "hash").agg(
            F.count("*").alias("n"), F.max("twice").alias("twice"),
            F.min(F.struct("key", "start", "size")).alias("one")), f"kinds{name}")
        different = self.store(kinds.groupBy("name").agg(
            F.count("*").alias("different"), F.max("twice").alias("any_twice")).where(
                "different > 1 or any_twice"), f"different{name}")
        wanted = self.store(kinds.join(different, "name").select(
            "name", "one.*", (F.col("n") == 1).alias("alone"),
            (F.col("different") > self.large).alias("large")), f"wanted{name}")
        again = kinds.where("n > 1").select("name", "hash")
        copies = shared.join(again, ["name", "hash"]).select(
            "key", "start", (F.col("start") + F.col("size")).alias("stop"))
        return shared, wanted, copies

    def compare(self, texts: DataFrame, wanted: DataFrame, name: str) -> list[DataFrame]:
        """Spans of the wanted pieces that go to shards; none if all are of large names."""
        size = wanted.where("not large").agg(F.sum("size")).first()[0]
        if not size:
            return []
        shards = -(-size // self.shard_bytes)
        return [self.store(_compare(_cut(texts, False), shards, self.least), f"met{name}")]

    def run(self) -> tuple[DataFrame, DataFrame]:
        """Texts that may repeat in part (key, text, needs), and spans (key, start, stop)."""
        shared, wanted, copies = self.level(_all_pieces(self.docs, self.least), "")
        texts = self.docs.groupBy("key").agg(F.first("text").alias("text"))
        touched = self.store(texts.join(
            shared.select("key").distinct().join(_needs(wanted), "key", "left"), "key"), "touched")
        spans = [copies, *self.compare(touched, wanted, "")]
        if not wanted.where("large").isEmpty():
            _, wanted, copies = self.level(_smaller_pieces(_cut(touched, True), self.least), "_2")
            cut = self.store(touched.select("key", "text").join(_needs(wanted), "key"), "cut_2")
            spans += [copies, *self.compare(cut, wanted, "_2")]
            windows = self.store(_each_window(_cut(cut, True), self.least), "windows")
            often = self.store(windows.groupBy("name", "hash").count().where(
                "count > 1").drop("count"), "often")
            spans.append(windows.join(often, ["name", "hash"]).select(
                "key", "start", (F.col("start") + self.least).alias("stop")))
        return touched, self.store(reduce(DataFrame.union, spans).distinct(), "spans")


def _needs(wanted: DataFrame) -> DataFrame:
    """The wanted pieces of each text."""
    return wanted.groupBy("key").agg(F.collect_list(F.struct(
        "name", "start", "size", "alone", "large")).alias("needs"))


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, ascending; spans that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > stops[:-1]
    return starts[new], stops[np.append(new[1:], True)]


def _results(docs: DataFrame, text_col: str, least: int, shard_bytes: int, large: int,
             kept: bool) -> DataFrame:
    """key, n_removed, n_spans, removed (spans), kept_sha256, kept of texts that lose something."""
    touched, spans = _Search(docs, text_col, least, shard_bytes, large).run()
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = []
                for key, text, found in zip(*(part.column(c) for c in ("key", "text", "spans"))):
                    raw = text.as_py().encode()
                    flat = found.values
                    starts, stops = _merged(flat.field("start").to_numpy(),
                                            flat.field("stop").to_numpy())
                    left = b"".join(raw[a:b] for a, b in zip([0, *stops], [*starts, len(raw)]))
                    out.append({
                        "key": key.as_py(), "n_removed": len(raw) - len(left),
                        "n_spans": len(starts), "kept_sha256": hashlib.sha256(left).hexdigest(),
                        "removed": [{"start": a, "stop": b} for a, b in
                                    zip(starts.tolist(), stops.tolist())],
                        "kept": left.decode("utf-8", "ignore") if kept else None})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("key", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()),
                    ("removed", pa.list_(pa.struct([("start", pa.int64()),
                                                    ("stop", pa.int64())]))),
                    ("kept", pa.string())]))

    return touched.select("key", "text").join(spans, "key").mapInArrow(
        run, "key binary, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "removed array<struct<start: bigint, stop: bigint>>, kept string")


def find(docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
         shard_bytes: int = SHARD_BYTES, large: int = LARGE) -> DataFrame:
    """One row per document: its id, n_bytes, n_removed, n_spans, kept_sha256, removed.

    removed: the spans, as byte offsets, end exclusive; empty where nothing repeats.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    found = _results(docs, text_col, least, shard_bytes, large, kept=False)
    stored = f"{scratch_dir(docs.sparkSession, 'repeats')}/found"
    found.drop("kept").write.parquet(stored)
    found = docs.sparkSession.read.parquet(stored).withColumnsRenamed(
        {"key": "_key", "kept_sha256": "_kept"})
    own = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"),
                      F.length(text).cast("bigint").alias("n_bytes"),
                      F.sha2(text, 256).alias("_whole"))
    none = F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)")
    zero = F.lit(0).cast("bigint")
    return own.join(found, "_key", "left").select(
        F.col("_id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("_kept", "_whole").alias("kept_sha256"),
        F.coalesce("removed", none).alias("removed"))


def remove(docs: DataFrame, *, least: int = LEAST, text_col: str = "text",
           shard_bytes: int = SHARD_BYTES, large: int = LARGE) -> DataFrame:
    """The rows of `docs` with repeated bytes taken out of their texts.

    Of a character that was cut in the middle nothing stays; a null text stays null.
    """
    stored = f"{scratch_dir(docs.sparkSession, 'repeats')}/kept"
    _results(docs, text_col, least, shard_bytes, large, kept=True).select(
        F.col("key").alias("_key"), F.col("kept").alias("_kept")).write.parquet(stored)
    rows = docs.select(F.struct("*").alias("_row"), text_key(F.col(text_col)).alias("_key"))
    left = docs.sparkSession.read.parquet(stored)
    fields = {c: F.col("_row").getField(c) for c in docs.columns}
    fields[text_col] = F.when(fields[text_col].isNotNull(),
                              F.coalesce("_kept", fields[text_col]))
    return rows.join(left, "_key", "left").select([f.alias(c) for c, f in fields.items()])
