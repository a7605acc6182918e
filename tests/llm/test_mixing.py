from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DOCUMENTS, words

from pairloom.llm import mixing
from pairloom.llm.queries import QUERIES


def targets(sizes):
    """By the contract's words: share, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped.update(over)


def check(rows, documents):
    sizes = Counter()
    for r in documents:
        sizes[r.source] += len(words(r.text))
    want = targets(sizes)
    by_id = defaultdict(list)
    for r in documents:
        by_id[r.doc_id].append(r)
    taken = Counter()
    for row in rows:
        source = by_id[row.doc_id][0].source
        assert row.size in {len(words(d.text)) for d in by_id[row.doc_id]}
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(want[source])
        assert 0 <= row.taken <= 3 * row.size
        taken[source] += row.taken
    return sizes, want, taken


def test_query(spark, documents, sf_dir):
    rows = QUERIES["op9_mixing"](spark, sf_dir).collect()
    texts = documents.collect()
    _, want, taken = check(rows, texts)
    largest = max(len(words(r.text)) for r in texts)
    assert all(abs(taken[s] - t) <= largest for s, t in want.items())
    again = QUERIES["op9_mixing"](spark, sf_dir).collect()
    assert Counter(map(repr, rows)) == Counter(map(repr, again))
    # Each copy has its shard, and every shard its share of the words.
    assert all(r.taken == len(r.shards) * r.size for r in rows)
    held = Counter()
    for r in rows:
        for shard in r.shards:
            held[shard] += r.size
    assert sorted(held) == list(range(mixing.LEAST_SHARDS))
    assert max(held.values()) < 3 * sum(held.values()) / len(held)


def many(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 40)), "en", s, 0)
            for i, s in enumerate(rng.choice(["a", "b", "c", "tiny", "é"], 3000,
                                             p=[0.6, 0.2, 0.1, 0.01, 0.09]).tolist())]
    rows += [(5000 + i, "x y z", "en", None, 0) for i in range(20)]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_targets_are_met_closely(spark):
    frame = many(spark)
    sizes, want, taken = check(mixing.draws(frame).collect(), frame.collect())
    for source, target in want.items():
        assert abs(taken[source] - target) <= 3
    assert want["tiny"] == 3 * sizes["tiny"] and want[None] == 3 * sizes[None]


@pytest.mark.parametrize("shard_words", [200, 3000])
def test_shards_split_every_source_evenly(spark, shard_words):
    frame = many(spark)
    rows = mixing.draws(frame, shard_words=shard_words).collect()
    held = defaultdict(Counter)
    for row in rows:
        for shard in row.shards:
            held[shard][row.source_size] += row["size"]
    total = sum(map(len, map(words, (r.text for r in frame.collect()))))
    shards = -(-total // shard_words)
    assert max(held) < shards and len(held) > shards / 2
    if shard_words == 3000:
        want = Counter()
        for counts in held.values():
            want.update(counts)
        largest = max(want, key=want.get)
        shares = [c[largest] / sum(c.values()) for c in held.values()]
        assert np.std(shares) < 0.1


def test_quotas_are_exact(spark):
    blocks = spark.createDataFrame([("=a", 700), ("=b", 31), ("null", 5)], "source_key string, n int")
    for shards in (1, 3, 200):
        rows = mixing.shard_quotas(blocks, shards).collect()
        for key, n in (("=a", 700), ("=b", 31), ("null", 5)):
            runs = sorted((r["first"], r["n"], r.shard) for r in rows if r.source_key == key)
            ends = [f + m for f, m, _ in runs]
            assert [f for f, _, _ in runs] == [0, *ends[:-1]] and ends[-1] == n
            assert [s for _, _, s in runs] == sorted(s for _, _, s in runs)
        totals = Counter()
        for r in rows:
            totals[r.shard] += r["n"]
        assert max(totals.values()) - min(totals.values()) <= 2


def test_mixed_rows(spark, tmp_path):
    frame = many(spark)
    want = Counter({r.doc_id: len(r.shards) for r in mixing.draws(frame).collect()})
    mixed = mixing.mix(frame)
    assert mixed.schema.names == frame.schema.names
    assert Counter(r.doc_id for r in mixed.collect()) == +want
    mixing.write_shards(frame, str(tmp_path / "mix"), shard_words=4000)
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert Counter(r.doc_id for r in written.collect()) == +want


def in_shards(frame):
    """The ids of each shard, in the order that the copies' hashes give."""
    facts = mixing.draws(frame, carry=["doc_id"])
    shards = defaultdict(list)
    for r in facts.select("row.doc_id", mixing.F.posexplode("shards").alias("copy", "shard"),
                          "hash").withColumn("order", mixing.copy_order(
                              mixing.F.col("hash"), mixing.F.col("copy"))).collect():
        shards[r.shard].append((r.order, r.doc_id))
    return {shard: [i for _, i in sorted(rows)] for shard, rows in shards.items()}


def test_mix_is_shuffled_within_shards(spark, tmp_path):
    frame = many(spark)
    shards = in_shards(frame)
    assert len(shards) == mixing.LEAST_SHARDS
    path = str(tmp_path / "mix")
    mixing.write_shards(frame, path)
    for shard, ids in shards.items():
        found = spark.read.parquet(f"{path}/mix_shard={shard}").collect()
        assert [r.doc_id for r in found] == ids and ids != sorted(ids)
    # The mix itself is the shards' rows, each shard in one piece.
    mixed = "," + ",".join(str(r.doc_id) for r in mixing.mix(frame).collect()) + ","
    assert all("," + ",".join(map(str, ids)) + "," in mixed for ids in shards.values())


def test_awkward_rows(awkward):
    documents = awkward.collect()
    rows = mixing.draws(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in documents)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.draws(awkward.where("false")).count() == 0
    assert mixing.draws(awkward.where("text is null")).agg({"taken": "sum"}).first()[0] == 0
