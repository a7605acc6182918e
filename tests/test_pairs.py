"""Pair operators against plain Python on small random frames with nulls and hot keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom import plans
from pairloom.operators import (
    canonical_pair,
    combine,
    combine_matches,
    combine_rejects,
    dedupe_pairs,
    earliest_per_pair,
    mirror_pairs,
    orient_pairs,
    prune_rejected,
    rewrite_alias,
    settle_pairs,
)
from pairloom.rules import MATCH_FAMILIES, REJECT
from pairloom.schema import JOIN_KEYS, LABELLED, PAIR, SIDES, conform

NAMES = LABELLED.names
OTHERS = [c for c in NAMES if c not in JOIN_KEYS]


def labelled_rows(seed, n=400):
    """About a third of the rows share one pair; keys, times and scores repeat and are null."""
    rnd = random.Random(seed)
    keys = [None, "", "-<>a<>b", "1<>a<>b", "2<>a<>b", "x<>c<>d", "X<>c<>d"]
    out = []
    for _ in range(n):
        hot = rnd.random() < 0.33
        a, b = ("hot<>a<>b", "-<>a<>b") if hot else (rnd.choice(keys), rnd.choice(keys))
        out.append((f"u{rnd.randint(0, 3)}", rnd.choice([None, "u1", "u2"]), a, b,
                    rnd.choice([None, "1", "2"]), "s<>t", rnd.choice([None, "v<>w"]),
                    rnd.choice([None, 5, 6]), rnd.choice(["upc", "manual"]),
                    rnd.choice(["exact_match", "similar_match", REJECT]),
                    rnd.choice(["pets", "grocery"]), rnd.randint(0, 2)))
    return out


@pytest.fixture(params=[1, 2])
def rows(request):
    return labelled_rows(request.param)


@pytest.fixture
def frame(spark, rows):
    return spark.createDataFrame(rows, LABELLED).repartition(5)


def multiset(df_or_rows):
    rows = df_or_rows if isinstance(df_or_rows, list) else df_or_rows.collect()
    return Counter(tuple(r) for r in rows)


def rank(row, order=("priority", "match_timestamp")):
    get = dict(zip(NAMES, row))
    first = [(get[c] is None, get[c] or 0) for c in order]
    rest = [(get[c] is not None, get[c] or "") for c in OTHERS if c not in order]
    return first + [(flag, str(v)) for flag, v in rest]


def survivors(rows, key=lambda r: (r[2], r[3])):
    best = {}
    for r in rows:
        k = key(r)
        if k not in best or rank(r) < rank(best[k]):
            best[k] = r
    return list(best.values())


def oriented(row):
    a, b = row[2], row[3]
    turn = a is not None and (b is None or a > b)
    if not turn:
        return row
    return (row[1], row[0], row[3], row[2], row[4], row[6], row[5], *row[7:])


def split(rows):
    return [r for r in rows if r[9] != REJECT], [r for r in rows if r[9] == REJECT]


def without_priority(rows):
    return [r[:-1] for r in rows]


def test_dedupe(frame, rows):
    got = dedupe_pairs(frame, order=("priority", "match_timestamp"))
    assert got.columns == NAMES
    assert multiset(got) == multiset(survivors(rows))


def test_dedupe_does_not_depend_on_partitions(frame):
    assert multiset(dedupe_pairs(frame)) == multiset(dedupe_pairs(frame.repartition(13)))


def test_dedupe_undirected(frame, rows):
    def ordered(r):
        known = [k for k in (r[2], r[3]) if k is not None]
        low, high = (min(known), max(known)) if known else (None, None)
        return (*r[:2], low, high, *r[4:])
    got = dedupe_pairs(frame, order=("priority", "match_timestamp"), undirected=True)
    assert multiset(got) == multiset(survivors([ordered(r) for r in rows]))


def test_dedupe_undirected_turning_all_sides(frame, rows):
    got = dedupe_pairs(frame, order=("priority", "match_timestamp"), undirected=True, sides=SIDES)
    assert multiset(got) == multiset(survivors([oriented(r) for r in rows]))


def test_orient(frame, rows):
    assert multiset(orient_pairs(frame)) == multiset([oriented(r) for r in rows])


def test_canonical_pair_and_half_null_pairs(spark):
    df = spark.createDataFrame([("b", "a"), ("a", None), (None, None)], "uuid_a string, uuid_b string")
    assert multiset(canonical_pair(df)) == multiset([("a", "b"), ("a", "a"), (None, None)])
    assert multiset(canonical_pair(df, drop_half_null=True)) == multiset([("a", "b")])


@pytest.mark.parametrize("undirected", [False, True])
@pytest.mark.parametrize("prune", [False, True])
def test_settle(frame, rows, prune, undirected):
    if undirected:
        rows = [oriented(r) for r in rows]
    matches, rejects = (survivors(part) for part in split(rows))
    if prune:
        gone = {frozenset(r[2:4]) for r in rejects if None not in r[2:4]}
        matches = [m for m in matches if frozenset(m[2:4]) not in gone]
    got = settle_pairs(frame, prune=prune, undirected=undirected)
    assert got.columns == PAIR.names
    assert multiset(got) == multiset(without_priority(matches + rejects))


@pytest.mark.parametrize("prune", [False, True])
def test_settle_equals_the_operators_one_by_one(frame, prune):
    frame = frame.withColumns({k: F.lower(k) for k in JOIN_KEYS})
    order = ("priority", "match_timestamp")
    rejects = dedupe_pairs(frame.where(F.col("type") == REJECT), order=order)
    matches = dedupe_pairs(frame.where(F.col("type") != REJECT), order=order)
    if prune:
        matches = prune_rejected(matches, rejects)
    assert multiset(settle_pairs(frame, prune=prune)) == multiset(
        conform(matches, PAIR).unionByName(conform(rejects, PAIR)))


@pytest.mark.parametrize("undirected", [False, True])
def test_prune_rejected(spark, frame, rows, undirected):
    matches, rejects = split(rows)
    def low(r):
        return tuple(k.lower() if k is not None else None for k in r[2:4])
    gone = {low(r) for r in rejects if None not in r[2:4]}
    if undirected:
        gone |= {k[::-1] for k in gone}
    want = [m for m in matches if low(m) not in gone]
    got = prune_rejected(frame.where(F.col("type") != REJECT),
                         frame.where(F.col("type") == REJECT), undirected=undirected)
    assert got.columns == NAMES
    assert multiset(got) == multiset(want)


def test_no_pruned_pair_is_rejected_in_either_direction(frame):
    rejects = frame.where(F.col("type") == REJECT)
    left = prune_rejected(frame.where(F.col("type") != REJECT), rejects)
    low = [F.lower(k) for k in JOIN_KEYS]
    both = {tuple(r) for r in left.select(*low).distinct().collect()}
    bad = {tuple(r) for r in rejects.select(*low).distinct().collect()}
    bad |= {k[::-1] for k in bad}
    assert not {k for k in both & bad if None not in k}


def test_earliest_keeps_ties_and_takes_null_first(frame, rows):
    first = {}
    for r in rows:
        t = -1 if r[7] is None else r[7]
        first[r[2:4]] = min(t, first.get(r[2:4], t))
    want = [r for r in rows if (-1 if r[7] is None else r[7]) == first[r[2:4]]]
    assert multiset(earliest_per_pair(frame)) == multiset(want)


def test_mirror_twice_is_everything_twice(frame):
    once = mirror_pairs(frame)
    twice = multiset(mirror_pairs(once))
    assert twice == Counter({k: 2 * n for k, n in multiset(once).items()})


def test_mirror_swaps_sides_only(spark):
    row = ("ua", "ub", "sa", "sb", "1", "ba", "cb", 5, "upc", "exact_match", "pets")
    got = mirror_pairs(spark.createDataFrame([row], PAIR))
    assert multiset(got) == multiset(
        [row, ("ub", "ua", "sb", "sa", "1", "cb", "ba", 5, "upc", "exact_match", "pets")])


def test_rewrite_alias_of_chosen_rows(spark):
    df = spark.createDataFrame([("oldold", "m"), ("old", "r"), ("old", None)], "k string, t string")
    got = rewrite_alias(df, ["k"], {"old": "new"}, where=F.col("t") != "r")
    assert multiset(got) == multiset([("newnew", "m"), ("old", "r"), ("old", None)])


def test_combine_priorities(frame):
    got = combine_matches([frame.where("priority = 1"), frame.where("priority = 0")])
    counts = {r[0]: r[1] for r in got.groupBy("priority").count().collect()}
    want = {r[0]: r[1] for r in frame.groupBy("priority").count().collect()}
    assert counts == {0: want[1], 1: want[0]}


def test_warehouse_equals_the_families_step_by_step(warehouse_inputs):
    """Each family de-duplicated first, then all combined, against the one-pass build."""
    library, reviews, feeds = (warehouse_inputs[k] for k in ("library", "reviews", "feeds"))
    matches = plans.library_matches(library)
    families = [*(matches.where(F.col("segment") == s) for s in MATCH_FAMILIES[:3]),
                plans.review_matches(reviews),
                *(plans.feed_matches(feeds[f], f) for f in MATCH_FAMILIES[4:])]
    rejects = combine_rejects([plans.library_rejects(library), plans.review_rejects(reviews)])
    for options in ({}, {"prune": True}, {"undirected": True},
                    {"prune": True, "alias_rejects": True}):
        stepwise = plans.build_warehouse(combine_matches(families), rejects, "2024-01-05", **options)
        direct = plans.warehouse_from_sources(library, reviews, feeds, "2024-01-05", **options)
        assert multiset(stepwise) == multiset(direct)


def test_warehouse_keys_are_those_of_two_dedupes_around_the_alias(warehouse_inputs):
    library, reviews, feeds = (warehouse_inputs[k] for k in ("library", "reviews", "feeds"))
    pairs = combine([plans.library_pairs(library), plans.review_pairs(reviews),
                     *(plans.feed_pairs(f, n) for n, f in feeds.items())])
    matches = pairs.where(F.col("type") != REJECT)
    chain = rewrite_alias(matches.dropDuplicates(list(JOIN_KEYS))).dropDuplicates(list(JOIN_KEYS))
    direct = plans.warehouse_from_sources(library, reviews, feeds, "2024-01-05")
    mirrored = mirror_pairs(chain.select(*PAIR.names)).select(*JOIN_KEYS)
    assert multiset(mirrored) == multiset(
        direct.where(F.col("type") != REJECT).select(*JOIN_KEYS))


def test_rows_of_no_type_are_kept(spark):
    row = ("ua", "ub", "sa", "sb", "1", "ba", "cb", 5, "upc", None, "pets", 0)
    assert multiset(settle_pairs(spark.createDataFrame([row], LABELLED))) == multiset([row[:-1]])


def test_combine_counts_frames_without_priorities(spark):
    row = ("ua", "ub", "sa", "sb", "1", "ba", "cb", 5, "upc", "exact_match", "pets")
    plain = spark.createDataFrame([row], PAIR)
    got = combine([plain, plain, plain.withColumn("priority", F.lit(9))])
    assert sorted(r.priority for r in got.collect()) == [0, 1, 9]


def test_keys_may_prefer_by_segment(warehouse_inputs):
    library = warehouse_inputs["library"]
    mixed = plans.library_pairs(library, F.col("segment") == "pets")
    apart = plans.library_pairs(library, "sku").where("segment = 'pets'").unionByName(
        plans.library_pairs(library, "upc").where("segment <> 'pets'"))
    assert multiset(mixed) == multiset(apart)


def test_other_keys_turn_with_the_sides(spark):
    df = spark.createDataFrame([("b", "a", 1, 2), ("a", "b", 3, 4)], "x string, y string, p int, q int")
    assert multiset(orient_pairs(df, ("x", "y"), [("p", "q")])) == multiset(
        [("a", "b", 2, 1), ("a", "b", 3, 4)])
    assert multiset(dedupe_pairs(df.select("x", "y"), ("x", "y"), order=(), undirected=True)) == \
        multiset([("a", "b")])
