"""N-gram Jaccard join by prefix filters under several global token orders, and its components.

A text's tokens are its distinct word n-grams, held as 64-bit hashes. Texts of one token set are a
class. If two sets reach the similarity, then under any order of all tokens their prefixes share a
token. The first order puts tokens found often last; its prefixes are the index. A pair from the
index must have sizes that allow the similarity, a first common token early enough in both sets, and
parity bits that allow it: each token turns one of a set's bits, so that sets differ in at least as
many tokens as bits; a set has at least as many bits as tokens. Where a token is in many classes, its
index entries carry the bits, folded to those of the smallest sets, so that they are compared while
pairs are found: only pairs that pass become rows. Then a pair must also share a token in
the prefixes under the other orders (hashes with other seeds), of which 32 bits to a token are
joined to the pairs. Only pairs that pass all these filters get their whole sets, on which they are
verified.

Components come in two rounds, so that a large group of near copies does not become all its pairs:
classes that share an index token are first compared with the `FIRST` least ones of them, or the
`LEADERS` least ones where they are more than `LARGE`, and then only if they are in different
components. Pairs within a component that is already known need no proof, and no other pair is left
out.

Null and wordless texts have no tokens and are linked with nothing. Texts of fewer than n words are
one token. Repeated rows are copies. A component's id is its least id that is not null. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.scratch import remove, scratch_dir

from .components import connected_components
from .words import Words, mix, text_slices, word_ngrams

N = 4
PERCENT = 85
ORDERS = 3                   # the index's and two more
LARGE = 32
LEADERS = 64                 # of a group may be unlike many members; enough join nearly all
FIRST = 3                    # leaders where at most LARGE share a token
FREQUENT = 1 << 19           # tokens, at most, that are known to be frequent
_LOCAL = 3                   # texts of one stretch that hold a token before it is reported
_STRETCH = 1 << 22
_SMALL = 1_000_000           # rows that may be broadcast: 24 bytes each
_BITS = 1 << 8               # of the smallest sets' parity
_SEEDS = [np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)]


# ---- Token sets -------------------------------------------------------------------------

class TokenSets:
    """The token sets of the texts of a slice, each ascending by hash."""

    def __init__(self, texts, n: int):
        words = Words(texts)
        hashes = words.hashes(lower=True)
        tokens, at = word_ngrams(hashes, words.doc, n)
        rows = words.doc[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < n))
        if len(short):
            whole = [self._sequence(hashes[words.first[i]:words.first[i] + words.counts[i]])
                     for i in short]
            tokens, rows = np.append(tokens, whole), np.append(rows, short)
        order = np.lexsort((tokens, rows))
        tokens, rows = tokens[order], rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1])
        self.tokens, self.rows = tokens[new], rows[new]
        self.sizes = np.bincount(self.rows, minlength=words.n)
        self.begin = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def _sequence(hashes: np.ndarray) -> np.uint64:
        out = np.array([len(hashes)], np.uint64)
        for i in range(len(hashes)):
            out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[i:i + 1])
        return out[0]

    def classes(self) -> pa.Array:
        """A 128-bit fingerprint of each set; null where it is empty."""
        out = np.zeros((len(self.sizes), 2), np.uint64)
        used = self.sizes > 0
        for column, seed in enumerate(_SEEDS):
            mixed = mix(self.tokens ^ seed)
            if used.any():
                out[used, column] = np.add.reduceat(mixed, self.begin[used])
        raw = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(16), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())
        return pc.if_else(pa.array(used), raw, pa.scalar(None, pa.binary()))

    def parities(self) -> pa.Array:
        """Bits of each set, at least as many as tokens and a power of two; each token turns one."""
        wide = np.full(len(self.sizes), _BITS, np.int64)
        while (short := wide < self.sizes).any():
            wide[short] *= 2
        ends = np.cumsum(wide)
        where = mix(self.tokens ^ (_SEEDS[1] >> np.uint64(9))).view(np.int64)
        place = (ends - wide)[self.rows] + (where & (wide[self.rows] - 1))
        turned = (np.bincount(place, minlength=wide.sum()) & 1).astype(np.uint8)
        offsets = np.concatenate([[0], ends // 8]).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(wide), [
            None, pa.py_buffer(offsets.tobytes()),
            pa.py_buffer(np.packbits(turned, bitorder="little").tobytes())])

    def folds(self) -> pa.Array:
        """The parity of each set as if it had as many bits as the smallest sets have."""
        where = mix(self.tokens ^ (_SEEDS[1] >> np.uint64(9))).view(np.int64) & (_BITS - 1)
        turned = np.bincount(self.rows * _BITS + where, minlength=len(self.sizes) * _BITS) & 1
        packed = np.packbits(turned.astype(np.uint8), bitorder="little").view(np.int64)
        return _lists(packed, np.full(len(self.sizes), _BITS // 64))

    def ordered(self, keys: np.ndarray) -> np.ndarray:
        """Places of tokens by key within each set; equal keys by hash."""
        return np.lexsort((self.tokens, keys, self.rows))

    def prefixes(self, keys: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of each set by key, and how many they are."""
        order = self.ordered(keys)
        place = np.arange(len(order)) - np.repeat(self.begin, self.sizes)
        length = self.sizes - -(-percent * self.sizes // 100) + (self.sizes > 0)
        return self.tokens[order[place < np.repeat(length, self.sizes)]], length


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))


def _seeded(tokens: np.ndarray, order: int) -> np.ndarray:
    return mix(tokens ^ (_SEEDS[0] >> np.uint64(order)))


def _frequent_tokens(docs: DataFrame, text_col: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many texts hold, at most FREQUENT, and about how many texts hold each.

    Every task reports what it meets in several texts of a stretch. The order of tokens decides
    how much work there is, not what is found, so missing a rare token does no harm.
    """
    def run(batches):
        held, size = [], 0

        def report():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= _LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often])],
                names=["token", "n"])
        for batch in batches:
            for part in text_slices(batch, text_col):
                held.append(TokenSets(part.column(text_col), n).tokens)
                size += len(held[-1])
                if size >= _STRETCH:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    folder = scratch_dir(docs.sparkSession, "frequent")
    (docs.select(text_col).mapInArrow(run, "token bigint, n bigint")
     .groupBy("token").agg(F.sum("n").alias("n")).write.parquet(folder))
    counts = docs.sparkSession.read.parquet(folder)
    step = F.floor(F.log2(F.col("n").cast("double")) * 4).alias("step")
    held, least = 0, None
    for row in sorted(counts.groupBy(step).count().collect(), key=lambda r: -r.step):
        held += row["count"]
        if held > FREQUENT:
            break
        least = row.step
    rows = [] if least is None else counts.where(step >= least).collect()
    tokens = np.array([r.token for r in rows], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r.n for r in rows], np.int64)[order]


def _index_keys(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first order: other tokens by hash, then frequent ones by how many texts hold them."""
    keys = _seeded(tokens, 0) >> np.uint64(1)
    known, counts = frequent
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        found = known[at] == tokens
        often = np.minimum(counts[at[found]], (1 << 30) - 1).astype(np.uint64)
        keys[found] = (np.uint64(1) << np.uint64(63)) | (often << np.uint64(33)) | (
            keys[found] >> np.uint64(30))
    return keys


def _differ(a: bytes, b: bytes) -> int:
    """Bits in which two parities differ, as many as the shorter has: longer ones fold onto it."""
    a, b = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)))
    return int(np.bitwise_count(a ^ folded).sum())


def _prefix(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    length = len(tokens) - -(-percent * len(tokens) // 100) + 1
    return tokens[np.argpartition(_seeded(tokens, order), length - 1)[:length]]


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = int(np.isin(a, b, assume_unique=True).sum())
    return (100 + percent) * common >= percent * (len(a) + len(b))


def text_key(text: Column) -> Column:
    """Tells texts apart; null as empty."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "utf-8")))


# ---- The join ---------------------------------------------------------------------------

class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int):
        self.spark = docs.sparkSession
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        self.n, self.percent = n, percent
        self.folder = scratch_dir(self.spark, "jaccard")

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        """Written and read: work is done once, and joins shuffle stored sides themselves, so
        that a hot key can be split."""
        frame.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        """Remove a stored frame that nothing reads any more."""
        remove(self.spark, f"{self.folder}/{name}")

    def sketches(self) -> DataFrame:
        """id, key (of the text), class, size, prefix, bits, fold of every document."""
        frequent = _frequent_tokens(self.docs, self.text_col, self.n)
        text_col, n, percent = self.text_col, self.n, self.percent

        def run(batches):
            for batch in batches:
                for part in text_slices(batch, text_col):
                    sets = TokenSets(part.column(text_col), n)
                    prefix, length = sets.prefixes(_index_keys(sets.tokens, frequent), percent)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_id"), part.column("_key"), sets.classes(),
                         pa.array(sets.sizes.astype(np.int64)), _lists(prefix, length),
                         sets.parities(), sets.folds()],
                        names=["id", "key", "class", "size", "prefix", "bits", "fold"])

        kind = dict(self.docs.dtypes)[self.id_col]
        return self.docs.select(
            F.col(self.id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"),
            text_col).mapInArrow(run, f"id {kind}, key binary, class binary, size bigint, "
                                      "prefix array<bigint>, bits binary, fold array<bigint>")

    def places_allow(self, a: str, b: str) -> Column:
        """Sizes allow the similarity, and so does what follows the common token.

        a, b: columns with a size above 32 bits of the token's place.
        """
        size_a, size_b = (F.shiftright(c, 32) for c in (a, b))
        places = [F.col(c).bitwiseAND((1 << 32) - 1) for c in (a, b)]
        after = F.least(size_a - places[0], size_b - places[1])
        return ((100 * F.least(size_a, size_b) >= self.percent * F.greatest(size_a, size_b))
                & ((100 + self.percent) * after >= self.percent * (size_a + size_b)))

    def folds_allow(self, a: str, b: str, fold_a: str, fold_b: str) -> Column:
        """Folded parity bits allow the similarity. a, b: as for `places_allow`."""
        both = F.shiftright(a, 32) + F.shiftright(b, 32)
        differ = reduce(Column.__add__, [F.bit_count(F.col(fold_a)[i].bitwiseXOR(F.col(fold_b)[i]))
                                         for i in range(_BITS // 64)])
        return (100 + self.percent) * (both - differ) >= 2 * self.percent * both

    def bits_allow(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (a, b) whose parity bits allow the similarity."""
        percent = self.percent
        for c in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("no").alias(c), F.col("size").alias(f"{c}_size"),
                                              F.col("bits").alias(f"{c}_bits")), c)

        def run(batches):
            for batch in batches:
                both = (batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy())
                differ = np.array([_differ(x.as_py(), y.as_py()) for x, y in zip(
                    batch.column("a_bits"), batch.column("b_bits"))], np.int64)
                good = (100 + percent) * (both - differ) >= 2 * percent * both
                yield batch.select(["a", "b"]).filter(pa.array(good))

        return pairs.select("a", "b", "a_size", "b_size", "a_bits", "b_bits").mapInArrow(
            run, "a bigint, b bigint")

    def sets_of(self, classes: DataFrame, name: str) -> DataFrame:
        """no and tokens of the given classes (class, no), from the texts."""
        text_col, n = self.text_col, self.n

        def run(batches):
            for batch in batches:
                for part in text_slices(batch, text_col):
                    sets = TokenSets(part.column(text_col), n)
                    yield pa.RecordBatch.from_arrays(
                        [sets.classes(), _lists(sets.tokens, sets.sizes)],
                        names=["class", "tokens"])

        rows = self.docs.select(text_col).mapInArrow(run, "class binary, tokens array<bigint>")
        if classes.count() <= _SMALL:
            classes = F.broadcast(classes)
        # Copies have the same set: any one of them serves.
        return self.store(rows.join(classes, "class").groupBy("no").agg(
            F.first("tokens").alias("tokens")), f"sets_{name}")

    def links(self, classes: DataFrame, pairs: DataFrame, known: DataFrame, name: str,
              own: DataFrame | None = None) -> DataFrame | None:
        """The pairs (a, b) that are similar enough; None if there are no pairs at all.

        known: pairs whose folded bits allow it, and `settled`, whether no others are left to compare.
        own: no and own, the component of classes that are in one; pairs within one are left out.
        """
        pairs = pairs.select("a", "b", F.lit(False).alias("settled")).union(known).groupBy(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
                F.max("settled").alias("settled"))
        if own is not None:
            for c in ("a", "b"):
                pairs = pairs.join(own.select(F.col("no").alias(c), F.col("own").alias(f"own_{c}")),
                                   c, "left")
            pairs = pairs.where(F.col("own_a").isNull() | F.col("own_b").isNull()
                                | (F.col("own_a") != F.col("own_b"))).select("a", "b", "settled")
        pairs = self.store(pairs, f"found_{name}")
        pairs = self.store(pairs.where("settled").select("a", "b").union(
            self.bits_allow(pairs.where("not settled"), classes)), f"pairs_{name}")
        self.drop(f"found_{name}")
        if pairs.isEmpty():
            return None
        either = pairs.select(F.col("a").alias("no")).union(pairs.select("b")).distinct()
        sets = self.sets_of(self.store(classes.select("class", "no").join(
            either, "no", "left_semi"), f"classes_{name}"), name)
        pairs = self.store(self.share_prefixes(sets, pairs), f"shared_prefixes_{name}")
        left = sets.select(F.col("no").alias("a"), F.col("tokens").alias("tokens_a"))
        right = sets.select(F.col("no").alias("b"), F.col("tokens").alias("tokens_b"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")
        percent = self.percent

        def run(batches):
            for batch in batches:
                good = [_similar(x.values.to_numpy().view(np.uint64),
                                 y.values.to_numpy().view(np.uint64), percent)
                        for x, y in zip(batch.column(2), batch.column(3))]
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        found = self.store(joined.mapInArrow(run, "a bigint, b bigint"), f"links_{name}")
        for part in ("sets", "pairs", "classes", "shared_prefixes"):
            self.drop(f"{part}_{name}")
        return found

    def share_prefixes(self, sets: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that share a token in the prefixes under each further order."""
        percent, names = self.percent, [f"order_{i}" for i in range(1, ORDERS)]

        def run(batches):
            for batch in batches:
                tokens = [t.values.to_numpy().view(np.uint64) for t in batch.column("tokens")]
                columns = [pa.array([_prefix(t, i, percent).astype(np.uint32).view(np.int32)
                                     for t in tokens], pa.list_(pa.int32()))
                           for i in range(1, ORDERS)]
                yield pa.RecordBatch.from_arrays([batch.column("no"), *columns],
                                                 names=["no", *names])

        prefixes = sets.select("no", "tokens").mapInArrow(
            run, "no bigint, " + ", ".join(f"{n} array<int>" for n in names))
        left = prefixes.withColumnsRenamed({n: f"a_{n}" for n in names}).withColumnRenamed("no", "a")
        right = prefixes.withColumnsRenamed({n: f"b_{n}" for n in names}).withColumnRenamed("no", "b")
        overlap = [F.arrays_overlap(f"a_{n}", f"b_{n}") for n in names]
        return pairs.join(left, "a").join(right, "b").where(reduce(Column.__and__, overlap)).select(
            "a", "b")

    def components(self, links: DataFrame, name: str) -> DataFrame:
        return connected_components(links, lambda f, part: self.store(f, f"{name}_{part}"))

    def run(self) -> DataFrame:
        """id, key, size, component_id, group of every document.

        Components may have one least id if it stands for several texts; their group differs.
        """
        sketches = self.store(self.sketches(), "sketches")
        classes = self.store(sketches.where("class is not null").groupBy("class").agg(
            F.min("id").alias("least_id"), F.first("size").alias("size"),
            F.first("prefix").alias("prefix"), F.first("bits").alias("bits"),
            F.first("fold").alias("fold")).withColumn(
                "no", F.monotonically_increasing_id()), "classes")
        facts = self.store(sketches.drop("prefix", "bits", "fold"), "facts")
        self.drop("sketches")
        # One shuffle serves the counts and the join with them. Tokens of one class, most of them, end
        # here; of a token's rows none waits for the others, however many there are.
        entries = classes.select("no", "size", F.posexplode("prefix").alias("place", "token")).select(
            "token", "no", F.shiftleft("size", 32).bitwiseOR(F.col("place").cast("bigint")).alias("at")
        ).repartition("token")
        shared = self.store(entries.join(
            entries.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "token"), "shared")
        few = self.store(shared.where(F.col("n") <= LARGE).drop("n"), "few")
        many = self.store(shared.where(F.col("n") > LARGE).drop("n").join(
            classes.select("no", "fold"), "no"), "many")
        self.drop("shared")
        # First round: each class with some of those that it shares a token with.
        place = F.row_number().over(Window.partitionBy("token").orderBy("no"))
        lead = many.withColumn("place", place).where(F.col("place") <= LEADERS).select(
            "token", F.col("no").alias("a"), F.col("at").alias("a_at"), F.col("fold").alias("a_fold"))
        star = many.join(lead, "token").where(
            (F.col("no") != F.col("a")) & self.places_allow("at", "a_at")
            & self.folds_allow("at", "a_at", "fold", "a_fold"))
        settled = (F.least(F.shiftright("at", 32), F.shiftright("a_at", 32)) <= _BITS).alias("settled")
        found = few.groupBy("token").agg(F.collect_list(F.struct("no", "at")).alias("rows"))
        leads = F.element_at(F.sort_array("rows.no"), F.least(F.size("rows"), F.lit(FIRST)))
        pairs = found.select("rows", leads.alias("leads")).select(
            F.explode("rows").alias("x"), "rows", "leads").select(
                "x", F.explode("rows").alias("y"), "leads").where(
                (F.col("x.no") < F.col("y.no")) & self.places_allow("x.at", "y.at")).select(
                    F.col("x.no").alias("a"), F.col("y.no").alias("b"), "leads")
        first = self.links(classes, pairs.where("a <= leads").drop("leads"),
                           star.select("a", F.col("no").alias("b"), settled), "first")
        # Second round: pairs of different components.
        own = None
        if first is not None:
            own = self.components(first, "first").toDF("no", "own")
            parts = self.store(many.join(own, "no", "left").withColumn(
                "part", F.coalesce("own", "no")).drop("own"), "parts")
        else:
            parts = many.withColumn("part", F.col("no"))
        # A token's main component is the one that holds most of its classes. Where many classes
        # share a token, one of the two is outside of it.
        main = self.store(parts.groupBy("token", "part").count().groupBy("token").agg(
            F.max_by("part", F.struct("count", "part")).alias("main")), "main")
        placed = self.store(parts.join(main, "token"), "placed")
        self.drop("parts")
        outside = placed.where("part != main").select(
            "token", F.col("no").alias("a"), F.col("part").alias("part_a"), F.col("at").alias("a_at"),
            F.col("fold").alias("a_fold"))
        rest = outside.join(placed, "token").where(
            (F.col("part_a") != F.col("part"))
            & ((F.col("part") == F.col("main")) | (F.col("a") < F.col("no")))
            & self.places_allow("a_at", "at") & self.folds_allow("a_at", "at", "a_fold", "fold"))
        second = self.links(classes, pairs.where("a > leads").drop("leads"),
                            rest.select("a", F.col("no").alias("b"), settled), "second", own)
        links = [found for found in (first, second) if found is not None]
        names = facts.select("id", "key", "class", "size")
        if not links:
            return names.join(classes.select("class", "least_id", "no"), "class", "left").select(
                "id", "key", "size", F.coalesce("least_id", "id").alias("component_id"),
                F.col("no").alias("group"))
        merged = self.components(reduce(DataFrame.union, links), "second")
        ids = classes.select(F.col("no").alias("node"), "class", "least_id")
        named = self.store(ids.join(merged, "node").groupBy("root").agg(
            F.min("least_id").alias("component_id")), "named")
        by_class = self.store(ids.join(merged.join(named, "root"), "node", "left").select(
            "class", F.coalesce("component_id", "least_id").alias("component_id"),
            F.coalesce("root", "node").alias("group")), "by_class")
        return names.join(by_class, "class", "left").select(
            "id", "key", "size", F.coalesce("component_id", "id").alias("component_id"), "group")


def components(docs: DataFrame, *, n: int = N, percent: int = PERCENT, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_shingles (set size), component_id.

    Documents are linked if 100 * intersection >= percent * union of their token sets.
    """
    return _Join(docs, id_col, text_col, n, percent).run().select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, n: int = N, percent: int = PERCENT, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, of one document to each component.

    That is the one of least id; of equal ids with other texts, that of least text hash; of rows
    equal in id and text, one. Where no row of a component has an id, it is that of least text hash.
    """
    join = _Join(docs, id_col, text_col, n, percent)
    found = join.store(join.run(), "found")
    kept = found.where("id = component_id").groupBy("id", "group").agg(F.min("key").alias("key"))
    nameless = found.where("id is null and component_id is null")
    alone = nameless.where("group is null").select("id", "key").distinct()
    least = nameless.where("group is not null").groupBy("group").agg(
        F.first("id").alias("id"), F.min("key").alias("key")).select("id", "key")
    kept = join.store(kept.select("id", "key").union(alone).union(least), "kept")
    times = found.groupBy("id", "key").count().where("count > 1").drop("count")

    def of(names: DataFrame) -> Column:
        return rows["id"].eqNullSafe(names["id"]) & rows["key"].eqNullSafe(names["key"])
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                       text_key(F.col(text_col)).alias("key"))
    # Only rows that are equal in id and text have to meet.
    repeated = join.store(times.join(kept, times["id"].eqNullSafe(kept["id"])
                                     & times["key"].eqNullSafe(kept["key"]), "left_semi"),
                          "repeated")
    single = join.store(kept.join(repeated, kept["id"].eqNullSafe(repeated["id"])
                                  & kept["key"].eqNullSafe(repeated["key"]), "left_anti"), "single")
    once = rows.join(single, of(single), "left_semi").select("row.*")
    more = rows.join(repeated, of(repeated), "left_semi").groupBy("id", "key").agg(
        F.first("row").alias("row")).select("row.*")
    return once.unionByName(more)
