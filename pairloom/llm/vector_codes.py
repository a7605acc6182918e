"""Vectors as short codes: one codebook to each part of a vector, distances by tries of parts.

A vector is turned into integers, floor(scale * x), and cut into equal parts. Each part is written
as the number of the nearest entry of its place's codebook. Codebooks begin with the vectors of the
least ids and are moved, round by round, to the means of the parts that are nearest to them.

Distances come from a trie. The different parts of a place, each with the number of vectors that
have it, are sorted, so that those with a common beginning are neighbours and a run of equal
beginnings is a node. A node's distances to all entries are its parent's and one more square, so
that parts share what their beginnings have in common. The trie is gone through depth first: the
stack holds the nodes on the way down with their distances, and a node with at most `_LEAVES` parts
below it is finished level by level in arrays. Leaves take the nearest entry, the lower of equals,
and add their parts, times their number, to its sum. Rounds read the stored parts, sorted over all
tasks; sums of a task are at most one row per entry and dimension. The last assignment goes through
the vectors themselves, with a trie for each batch.

Vectors that are null, empty, or hold a null or non-finite component take no part. Vectors must have
one length, which the number of parts divides, else an error is raised. Repeated rows each count and
are each encoded. A null id is encoded too; for the first entries such rows come last, as one id. Of
rows with one id the least vector stands for it. With fewer ids than entries the codebook is
smaller. Components beyond 2**26 after scaling saturate there, so that distances are exact. Sums of
errors beyond 64 bits are null. An empty table gives an empty result. Only the id, the vector and
the label are read, and other columns' names do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.scratch import scratch_dir

SCALE = 4096.0
PARTS = 8
ENTRIES = 16
ROUNDS = 6
_LEAVES = 2048
_LIMIT = float(1 << 26)


def whole_components(vector: Column, scale: float, limit: float) -> Column:
    """floor(scale * x) of each component, within the limit; null where one is null or not finite.

    An empty vector gives null too.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-limit), F.least(
        F.lit(limit), x.cast("double") * F.lit(scale)))))
    return F.when((F.size(vector) > 0) & finite, whole)


def one_length(vectors: DataFrame) -> int | None:
    """The length of all vectors; None if there are none."""
    least, most = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} components")
    return least


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column without nulls, one to a row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), -1)


# ---- The trie ---------------------------------------------------------------------------

def _finish(parts: np.ndarray, depth: int, distances: np.ndarray,
            book: np.ndarray) -> np.ndarray:
    """Distances of all parts below a node, level by level."""
    differ = np.zeros(parts.shape, bool)
    differ[0] = True
    differ[1:] = parts[1:] != parts[:-1]
    new = differ[:, :depth].any(1)
    node = np.zeros(len(parts), np.int64)
    held = distances[None, :]
    for level in range(depth, parts.shape[1]):
        new = new | differ[:, level]
        first = np.flatnonzero(new)
        held = held[node[first]] + (parts[first, level][:, None] - book[:, level]) ** 2
        node = np.cumsum(new) - 1
    return held[node]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each of the sorted, different parts: its nearest entry and the squared distance."""
    entry, least = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    stack = [(0, len(parts), 0, np.zeros(len(book), np.int64))]
    while stack:
        low, high, depth, distances = stack.pop()
        if high - low <= _LEAVES or depth == parts.shape[1]:
            found = _finish(parts[low:high], depth, distances, book)
            entry[low:high] = found.argmin(1)
            least[low:high] = found.min(1)
            continue
        values = parts[low:high, depth]
        first = low + np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        below = distances + (parts[first, depth][:, None] - book[:, depth]) ** 2
        children = list(zip(first, np.append(first[1:], high), below))
        # Small neighbours are finished together from this node.
        group, begin = [], low
        for start, stop, held in children:
            if stop - start > _LEAVES:
                if start > begin:
                    group.append((begin, start, depth, distances))
                group.append((start, stop, depth + 1, held))
                begin = stop
            elif stop - begin > _LEAVES:
                group.append((begin, start, depth, distances))
                begin = start
        if high > begin:
            group.append((begin, high, depth, distances))
        stack.extend(reversed(group))
    return entry, least


def _sorted_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different parts in order, and which of them each row is."""
    order = np.lexsort(parts.T[::-1])
    parts = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (parts[1:] != parts[:-1]).any(1)
    which = np.empty(len(parts), np.int64)
    which[order] = np.cumsum(new) - 1
    return parts[new], which


# ---- Codebooks --------------------------------------------------------------------------

def _round(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over the sorted parts (place, part, n)."""
    _, entries, width = books.shape

    def run(batches):
        sums = {}
        for batch in batches:
            places = batch.column("place").to_numpy()
            part, counts = matrix(batch.column("part")), batch.column("n").to_numpy()
            edges = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
            for low, high in zip(edges, np.append(edges[1:], len(places))):
                place = int(places[low])
                entry, _ = nearest(part[low:high], books[place])
                weighted = np.column_stack([part[low:high], np.ones(high - low, np.int64)])
                weighted *= counts[low:high, None]
                total = sums.setdefault(place, np.zeros((entries, width + 1), object))
                order = np.argsort(entry, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(entry[order]) != 0))
                total[entry[order[first]]] += np.add.reduceat(weighted[order], first)
        for place, total in sums.items():
            entry, dim = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({
                "place": np.full(len(entry), place, np.int32), "entry": entry.astype(np.int32),
                "dim": dim.astype(np.int32), "total": pa.array(
                    [int(t) for t in total[entry, dim]], pa.decimal128(38, 0))})

    rows = parts.mapInArrow(run, "place int, entry int, dim int, total decimal(38,0)").groupBy(
        "place", "entry", "dim").agg(F.sum("total").alias("total")).collect()
    totals = {(r.place, r.entry, r.dim): int(r.total) for r in rows}
    moved = books.copy()
    for place, entry in {key[:2] for key in totals}:
        count = totals[place, entry, width]
        moved[place, entry] = [totals.get((place, entry, d), 0) // count for d in range(width)]
    return moved


def _first_entries(vectors: DataFrame, entries: int, parts: int, width: int) -> np.ndarray:
    """Codebooks by place, entry and position of the vectors of the least ids."""
    ids = [r.id for r in vectors.select("id").distinct().orderBy(
        F.col("id").asc_nulls_last()).limit(entries).collect()]
    held = F.col("id").isin([i for i in ids if i is not None])
    if None in ids:
        held = F.coalesce(held, F.lit(False)) | F.col("id").isNull()
    rows = vectors.where(held).groupBy("id").agg(F.min("vector").alias("vector")).collect()
    by_id = {r.id: r.vector for r in rows}
    first = np.array([by_id[i] for i in ids], np.int64)
    return first.reshape(len(ids), parts, width).transpose(1, 0, 2).copy()


class Codebooks:
    """Codebooks, and the stored vectors (id, label, vector) that they were fitted on."""

    def __init__(self, vectors: DataFrame, books: np.ndarray):
        self.vectors, self.books = vectors, books

    @property
    def text(self) -> str:
        """All components by place, entry and position."""
        return ",".join(map(str, self.books.ravel().tolist()))

    def encode(self) -> DataFrame:
        """id, label, code (two hex digits to a part), error of every vector."""
        books = self.books
        parts, _, width = books.shape

        def run(batches):
            for batch in batches:
                vectors = matrix(batch.column("vector"))
                codes = np.empty((len(vectors), parts), np.uint8)
                error = np.zeros(len(vectors), np.int64)
                for place in range(parts):
                    part, which = _sorted_parts(vectors[:, place * width:(place + 1) * width])
                    entry, least = nearest(part, books[place])
                    codes[:, place], error = entry[which], error + least[which]
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"),
                     pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)],
                              pa.string()), pa.array(error)],
                    names=["id", "label", "code", "error"])

        kinds = dict(self.vectors.dtypes)
        return self.vectors.mapInArrow(
            run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def fit(table: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: float = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
        label_col: str = "label") -> Codebooks:
    """Codebooks of the table's vectors; `entries` is at most 256, as a code has a byte to a part."""
    if not 0 < entries <= 256:
        raise ValueError(f"{entries} entries do not fit a byte")
    spark = table.sparkSession
    folder = scratch_dir(spark, "codes")
    table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                 whole_components(F.col(vector_col), scale, _LIMIT).cast("array<int>").alias(
                     "vector")).where(
        "vector is not null").write.parquet(f"{folder}/vectors")
    vectors = spark.read.parquet(f"{folder}/vectors")
    length = one_length(vectors)
    if length is None:
        return Codebooks(vectors, np.zeros((parts, 0, 0), np.int64))
    if length % parts:
        raise ValueError(f"{length} components cannot be cut into {parts} equal parts")
    width = length // parts
    books = _first_entries(vectors, entries, parts, width)
    places = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(
        i.alias("place"), F.slice("vector", i * width + 1, F.lit(width)).alias("part")))
    vectors.select(F.inline(places)).groupBy("place", "part").agg(
        F.count("*").alias("n")).write.parquet(f"{folder}/parts")
    # Sorted over all tasks, so that neighbours share long beginnings.
    spark.read.parquet(f"{folder}/parts").repartitionByRange("place", "part").sortWithinPartitions(
        "place", "part").write.parquet(f"{folder}/sorted")
    stored = spark.read.parquet(f"{folder}/sorted")
    for _ in range(rounds):
        books = _round(stored, books)
    return Codebooks(vectors, books)


def encode(table: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           scale: float = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """id_col, code, error, label_error, codebooks_sha256 of every vector that takes part.

    error: the squared distances of its parts; label_error: their sum over rows of the same label,
    null being one.
    """
    spark = table.sparkSession
    fitted = fit(table, parts=parts, entries=entries, rounds=rounds, scale=scale, id_col=id_col,
                 vector_col=vector_col, label_col=label_col)
    folder = scratch_dir(spark, "codes")
    if fitted.books.size:
        codes = fitted.encode()
    else:
        codes = fitted.vectors.select("id", "label", F.lit("").alias("code"),
                                      F.lit(0).cast("bigint").alias("error"))
    codes.write.parquet(f"{folder}/codes")
    codes = spark.read.parquet(f"{folder}/codes")
    codes.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")
    ).write.parquet(f"{folder}/labels")
    labels = spark.read.parquet(f"{folder}/labels")
    digest = hashlib.sha256(fitted.text.encode()).hexdigest()
    return codes.join(labels, codes["label"].eqNullSafe(labels["_label"])).select(
        F.col("id").alias(id_col), "code", "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"))
