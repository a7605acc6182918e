"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

Each source gets a target: the sizes of all documents together, shared by weight, but never above
`MAX_PASSES` times the source's own size; what is above is shared again among the others. A source
is cut into blocks by a hash of its documents. Its target takes whole passes over its blocks, and
of a last pass the first blocks, the last of them up to a hash, and the document that comes nearest
to what is left. The tree hands these blocks to output shards: each node draws, without
replacement, how many blocks of each source go left, so that every shard holds near its share of
each source and the exact quotas are kept. Shards take disjoint runs of each source's permuted
blocks; the mix comes shard by shard, and the copies of a shard are ordered by a hash of their own.

Decisions depend on hashes and counts alone, so reruns agree. Rows that agree in id and text are
taken alike. A null or wordless text has size 0 and only comes along with whole blocks; a null
source is a source of its own; an empty table gives an empty mix. Texts are whole, however long;
a document is never cut. Other columns, of any names, come along in the mixed rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.scratch import scratch_dir

MAX_PASSES = 3
LEAST_BLOCKS = 256            # of each source
BLOCK_WORDS = 4_000_000       # above that number, words of all sources to a block's index
LEAST_SHARDS = 16
SHARD_WORDS = 50_000_000      # above that number of shards, words to a shard
SEED = 17

_WORD = r"[^\x20\x09-\x0D]+"
_SUBTREE = 64


def source_key(source: Column) -> Column:
    """A source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def text_size(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def row_hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(SEED), doc_id, text)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """source_key, source_size, target from (source, size) rows; weights repeat in source order.

    Sources are ordered by code point, null last. There is one row to a source, few enough to be
    ordered in one task. With sources in order of the size that each weight unit would buy, the
    capped ones come first; the rest share what is left.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").cast("string").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                          (F.col("place") % len(weights) + 1).cast("int"))
    capped = ranked.withColumns({"weight": weight, "cap": F.lit(MAX_PASSES) * F.col("source_size")})
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    all_rows = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rate = left / F.sum("weight").over(onward)
    shared = capped.withColumn("rate", rate).withColumn(
        "full", F.col("rate") * F.col("weight") >= F.col("cap"))
    # The first source below its cap sets the rate of all that follow.
    first = F.first(F.when(~F.col("full"), F.col("rate")), ignorenulls=True).over(all_rows)
    return shared.select(
        source_key(F.col("source")).alias("source_key"), "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
            first * F.col("weight")).alias("target"))


# ---- The splitting tree -----------------------------------------------------------------

def _children(low: int, high: int, counts: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """The two halves of the shards [low, high), with blocks drawn for the left one."""
    middle = (low + high) // 2
    total = int(counts.sum())
    left = round(total * (middle - low) / (high - low))
    drawn = np.random.default_rng([SEED, low, high]).multivariate_hypergeometric(
        counts, left, method="marginals")
    return [(low, middle, drawn), (middle, high, counts - drawn)]


def _expand(low: int, high: int, counts: np.ndarray, stop: int) -> Iterator[tuple]:
    """Nodes below one that hold at most `stop` shards, and no node above them."""
    nodes = [(low, high, counts)]
    while nodes:
        node = nodes.pop()
        if node[1] - node[0] <= stop:
            yield node
        else:
            nodes += _children(*node)


def shard_quotas(blocks: DataFrame, shards: int) -> DataFrame:
    """source_key, shard, first, n: the run of each source's blocks that a shard takes.

    blocks: (source_key, n) of every source. The tree's upper nodes are one row, of one number
    to a source; the nodes below are spread over tasks.
    """
    root = blocks.groupBy().agg(F.array_sort(F.collect_list(
        F.struct("source_key", F.col("n").cast("bigint").alias("n")))).alias("counts"))

    def split(stop):
        def run(batches):
            for batch in batches:
                rows = zip(*(c.to_pylist() for c in batch.columns))
                for low, high, keys, counts in rows:
                    found = list(_expand(low, high, np.array(counts, np.int64), stop))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([n[0] for n in found], pa.int64()),
                        pa.array([n[1] for n in found], pa.int64()),
                        pa.array([keys] * len(found), pa.list_(pa.string())),
                        pa.array([n[2].tolist() for n in found], pa.list_(pa.int64())),
                    ], names=["low", "high", "keys", "counts"])
        return run

    schema = "low bigint, high bigint, keys array<string>, counts array<bigint>"
    nodes = root.select(F.lit(0).cast("bigint").alias("low"),
                        F.lit(shards).cast("bigint").alias("high"),
                        F.col("counts.source_key").alias("keys"), F.col("counts.n").alias("counts"))
    nodes = nodes.where(F.size("keys") > 0)
    if shards > _SUBTREE:
        nodes = nodes.mapInArrow(split(-(-shards // _SUBTREE)), schema).repartition(_SUBTREE)
    leaves = nodes.mapInArrow(split(1), schema)
    each = (leaves.select(F.col("low").alias("shard"), F.inline(F.arrays_zip("keys", "counts")))
            .toDF("shard", "source_key", "n").where("n > 0"))
    earlier = Window.partitionBy("source_key").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    return each.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


# ---- Blocks and draws -------------------------------------------------------------------

def _plan(sized: DataFrame, weights, shard_words: int, store) -> DataFrame:
    """What each (source_key, bucket) gives: target, source_size, shards of whole passes, shard
    of a part, and up to which hash, or which single hash."""
    total = sized.agg(F.sum("size").alias("words")).first().words or 0
    buckets = max(LEAST_BLOCKS, -(-total // BLOCK_WORDS))
    shards = max(LEAST_SHARDS, -(-total // shard_words))
    bucket = F.pmod(F.xxhash64(F.lit(SEED + 1), "hash"), F.lit(buckets)).alias("bucket")
    sized = sized.select("source", source_key(F.col("source")).alias("source_key"), "size",
                         "hash", bucket)
    share = store(targets(sized, weights), "targets").withColumns({
        "passes": F.when(F.col("source_size") > 0, F.floor(
            F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("bigint"),
    }).withColumn("rest", F.greatest(
        F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    per_bucket = store(sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("words")),
                       "buckets")
    # The last pass takes buckets in order while they fit; the next one is cut by hash.
    upto = Window.partitionBy("source_key").orderBy("bucket")
    placed = per_bucket.withColumn("upto", F.sum("words").over(upto)).join(share, "source_key")
    placed = store(placed.select(
        "source_key", "bucket", "words", "source_size", "target", "passes",
        (F.col("upto") <= F.col("rest")).alias("whole"),
        (F.col("rest") - (F.col("upto") - F.col("words"))).alias("room")), "placed")
    edge = placed.where("not whole and room > 0").select("source_key", "bucket", "room")
    within = Window.partitionBy("source_key", "bucket").orderBy("hash")
    cut = (sized.join(edge, ["source_key", "bucket"])
           .groupBy("source_key", "bucket", "hash", "room").agg(F.sum("size").alias("size"))
           .withColumn("upto", F.sum("size").over(within)).where("upto <= room")
           .groupBy("source_key", "bucket").agg(F.max("hash").alias("cut"),
                                                F.max("upto").alias("cut_words")))
    edge = store(edge.join(cut, ["source_key", "bucket"], "left").select(
        "source_key", "bucket", "cut",
        (F.col("room") - F.coalesce("cut_words", F.lit(0))).alias("left")), "edge")
    # One more document of the source, not taken in this pass: the one nearest to what is left.
    free = (sized.join(placed.where("not whole").select("source_key", "bucket"),
                       ["source_key", "bucket"], "left_semi")
            .join(edge.select("source_key", "bucket", "cut"), ["source_key", "bucket"], "left")
            .where("cut is null or hash > cut")
            .groupBy("source_key", "bucket", "hash").agg(F.sum("size").alias("size")))
    single = (free.join(edge.select("source_key", "left"), "source_key")
              .where("size > 0 and size < 2 * left")
              .groupBy("source_key").agg(F.min_by(
                  F.struct("bucket", "hash"),
                  F.struct(F.abs(F.col("left") - F.col("size")), "hash")).alias("best"))
              .select("source_key", "best.bucket", F.col("best.hash").alias("single")))
    kinds = store(placed.select("source_key", "bucket", "source_size", "target", "passes", "whole")
                  .join(edge.select("source_key", "bucket", "cut"),
                        ["source_key", "bucket"], "left")
                  .join(single, ["source_key", "bucket"], "left"), "kinds")
    # A block is a bucket in one pass.
    part = F.col("whole") | F.col("cut").isNotNull() | F.col("single").isNotNull()
    drawn = kinds.select("source_key", "bucket", F.explode(F.concat(
        F.when(F.col("passes") > 0, F.sequence(F.lit(1).cast("bigint"), "passes"))
        .otherwise(F.array().cast("array<bigint>")),
        F.when(part, F.array(F.lit(0).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    )).alias("turn"))
    permuted = Window.partitionBy("source_key").orderBy(
        F.xxhash64(F.lit(SEED + 2), "source_key", "bucket", "turn"), "bucket", "turn")
    drawn = store(drawn.withColumn("ordinal", F.row_number().over(permuted) - 1), "drawn")
    quotas = shard_quotas(drawn.groupBy("source_key").agg(F.count("*").alias("n")), shards)
    owned = quotas.select("source_key", "shard", F.explode(F.sequence(
        "first", F.col("first") + F.col("n") - 1)).alias("ordinal"))
    dealt = drawn.join(owned, ["source_key", "ordinal"]).groupBy("source_key", "bucket").agg(
        F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    return store(kinds.drop("passes").join(dealt, ["source_key", "bucket"], "left"), "plan"), buckets


def draws(docs: DataFrame, *, weights: tuple[float, ...] = (1, 2, 3), id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source",
          shard_words: int = SHARD_WORDS, carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, size, source_size, target, shards, taken.

    shards: where its copies go, one entry to a copy. carry: columns that come along in a struct
    `row`, for `mix`.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "mix")

    def store(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    text = F.col(text_col)
    facts = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        text_size(text).alias("size"), row_hash(F.col(id_col), text).alias("hash"))
    if carry is None:
        rows = facts = store(facts, "sizes")
    else:
        rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                           text_size(text).alias("size"),
                           row_hash(F.col(id_col), text).alias("hash"),
                           F.struct(*(F.col(c) for c in carry)).alias("row"))
        facts = store(facts, "sizes")
    plan, buckets = _plan(facts, weights, shard_words, store)
    bucket = F.pmod(F.xxhash64(F.lit(SEED + 1), "hash"), F.lit(buckets))
    keyed = rows.withColumns({"source_key": source_key(F.col("source")), "bucket": bucket})
    in_part = F.col("whole") | (F.col("hash") <= F.col("cut")) | (F.col("hash") == F.col("single"))
    taken_turns = F.filter(F.coalesce("turns", F.array().cast(
        "array<struct<turn:bigint,shard:bigint>>")),
        lambda t: (t.turn > 0) | F.coalesce(in_part, F.lit(False)))
    return keyed.join(plan, ["source_key", "bucket"]).select(
        "id", "size", "source_size", "target", taken_turns.alias("turns"), "hash",
        *(["row"] if carry is not None else [])).select(
        F.col("id").alias(id_col) if carry is None else F.col("row"),
        "size", "source_size", "target", F.col("turns.shard").alias("shards"),
        (F.col("size") * F.size("turns")).alias("taken"), "hash")


def _copies(docs: DataFrame, **options) -> DataFrame:
    """row, shard: a row for each copy, shuffled within its shard, which one task holds."""
    taken = draws(docs, carry=docs.columns, **options)
    copies = taken.select("row", "hash", F.posexplode("shards").alias("copy", "shard"))
    order = copy_order(F.col("hash"), F.col("copy"))
    return (copies.withColumn("order", order).repartition("shard")
            .sortWithinPartitions("shard", "order").select("row", "shard"))


def copy_order(row: Column, copy: Column) -> Column:
    """Where a copy of a row stands within its shard."""
    return F.xxhash64(F.lit(SEED + 3), row, copy)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows of `docs`, with their columns, once for each time that they are taken.

    options: those of `draws`. Rows come shard by shard, shuffled within each.
    """
    return _copies(docs, **options).select("row.*")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The mix as Parquet, a folder to a shard, shuffled within each shard."""
    (_copies(docs, **options).select("row.*", F.col("shard").alias("mix_shard"))
     .write.partitionBy("mix_shard").parquet(path))
