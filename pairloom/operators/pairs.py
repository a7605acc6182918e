"""Operators on product pairs: ordering, de-duplication, pruning, mirroring, combining.

De-duplication keeps the least row of each group under a total order: the named order columns
first (nulls last), then all other columns. Where store aliases are to be rewritten, the columns
compare as they read afterwards: ties are broken on the text that goes into the warehouse, so that
it makes no difference whether aliases are rewritten before or after a step. The minimum of a struct in that order is a plain
aggregate, so every map task sends at most one row per key however hot the key is, and the
survivor does not depend on partitioning or on a retried task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import canonical, replace_all, turned
from ..rules import ALIASES, REJECT
from ..schema import JOIN_KEYS, LABELLED, PAIR, SIDES, quoted, union_conformed
from ..scratch import scratch_dir
from .projections import add_stores

Sides = Sequence[tuple[str, str]]
#: A frame, or one that several families are cut from, and the condition of each.
Family = DataFrame | tuple[DataFrame, Sequence[Column]]


def canonical_pair(df: DataFrame, a: str = "uuid_a", b: str = "uuid_b",
                   drop_half_null: bool = False) -> DataFrame:
    """Put the two columns in order.

    A pair with one side null becomes a pair of the other side with itself, unless dropped.
    """
    if drop_half_null:
        df = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    low, high = canonical(a, b)
    return df.withColumns({a: low, b: high})


def _swapped(when: Column, sides: Sides) -> dict[str, Column]:
    out = {}
    for a, b in sides:
        out[a] = F.when(when, F.col(b)).otherwise(F.col(a))
        out[b] = F.when(when, F.col(a)).otherwise(F.col(b))
    return out


def orient_pairs(df: DataFrame, keys: Sequence[str] = JOIN_KEYS, sides: Sides = SIDES) -> DataFrame:
    """Turn pairs around, all sides together, so that the keys are in order, nulls first."""
    if tuple(keys) not in sides:
        sides = [*sides, tuple(keys)]
    return df.withColumns(_swapped(turned(*keys), sides))


_SIDE_COLUMNS = tuple(c for s in SIDES for c in s)


def _ranked(order: Sequence[str], columns: Sequence[str],
            aliases: Mapping[str, str] | None = None) -> list[Column]:
    """Struct fields whose comparison is the survivor order over all of `columns`."""
    first = [f for c in order for f in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    others = [c for c in columns if c not in order]
    if not aliases:
        return first + [F.col(c) for c in others]
    # Where no alias is rewritten a column stands once, at its place in the order.
    shown = [c for c in others if c in _SIDE_COLUMNS]
    first += [replace_all(c, aliases).alias(f"_shown_{c}") if c in shown else F.col(c)
              for c in others]
    return first + [F.col(c) for c in shown]


def _hash_first(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Grouping columns that give the groups of the keys, a hash of them first.

    The least struct is found by sorting on the grouping columns, before the shuffle and after it. Keys
    often begin alike; a number in front decides nearly all comparisons. Keys of other types, as text
    that compares by a collation, are grouped as they are.
    """
    if all(df.schema[k].dataType == StringType() for k in keys):
        return [F.xxhash64(*keys).alias("_key_hash"), *map(F.col, keys)]
    return [F.col(k) for k in keys]


def dedupe_pairs(df: DataFrame, keys: Sequence[str] = JOIN_KEYS,
                 order: Sequence[str] = ("match_timestamp",),
                 undirected: bool = False, sides: Sides | None = None,
                 aliases: Mapping[str, str] | None = None) -> DataFrame:
    """One row per key combination (null keys are equal): the least in the survivor order.

    `undirected` puts the two keys in order first; with `sides` those columns turn with them.
    `aliases`: those that will be rewritten later.
    """
    columns = df.columns
    if undirected:
        df = canonical_pair(df, *keys) if sides is None else orient_pairs(df, keys, sides)
    others = [c for c in columns if c not in keys]
    if not others:
        return df.select(*columns).distinct()
    best = F.min(F.struct(*_ranked(order, others, aliases))).alias("_best")
    return (df.groupBy(*_hash_first(df, keys)).agg(best)
            .select(*[c if c in keys else F.col("_best")[c].alias(c) for c in columns]))


def earliest_per_pair(df: DataFrame, keys: Sequence[str] = JOIN_KEYS,
                      order: str = "match_timestamp") -> DataFrame:
    """All rows that hold the first place of their pair, ties kept, nulls first.

    The first places are aggregated and joined back rather than ranked in a window: a window
    would gather all ties of a pair in one task, while the join may split a hot pair. The rows are
    stored first, in the shared scratch folder, so that what they come from is computed once; the
    aggregation reads the keys and the order of them only.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "first_places")
    df.write.parquet(path)
    df = spark.read.schema(df.schema).parquet(path)
    first = (df.groupBy(*keys).agg(F.min(F.struct(order)).alias("_first"))
             .select(*[F.col(k).alias(f"_{k}") for k in keys],
                     F.col("_first")[order].alias(f"_{order}")))
    same = reduce(Column.__and__,
                  [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, order)])
    return df.join(first, same, "left_semi")


def prune_rejected(df: DataFrame, rejects: DataFrame, keys: Sequence[str] = JOIN_KEYS,
                   undirected: bool = True) -> DataFrame:
    """Pairs that are not among the rejects, in either direction when undirected.

    Keys compare in lower case, and a pair with a null key is never rejected. A third join key
    sees to that: 0 for whole pairs, and for the others -1 among the rejects and a positive row
    hash among the pairs, so that these do not all meet in one partition. With no join key
    nullable, no filter on the key expressions is pushed into the scans either.

    The rejects are made distinct on other columns than those joined on. Were they the same, the
    join would take over the partitioning of that step, and adaptive execution splits a hot pair
    only between a join and shuffles of its own.
    """
    def ordered() -> tuple[Column, Column, Column]:
        a, b = (F.lower(k) for k in keys)
        low, high = canonical(a, b) if undirected else (a, b)
        return low, high, a.isNotNull() & b.isNotNull()

    def join_keys(low: Column, high: Column, whole: Column, otherwise: Column) -> dict:
        return {"_low": F.coalesce(low, F.lit("")), "_high": F.coalesce(high, F.lit("")),
                "_whole": F.when(whole, F.lit(0).cast("bigint")).otherwise(otherwise)}

    columns = df.columns
    spread = 1 + F.xxhash64(*columns).bitwiseAND((1 << 62) - 1)
    low, high, whole = ordered()
    known = (rejects.select(F.when(whole, low).alias("_l"), F.when(whole, high).alias("_h"))
             .distinct()
             .select(*[c.alias(n) for n, c in join_keys(
                 F.col("_l"), F.col("_h"), F.col("_l").isNotNull(), F.lit(-1).cast("bigint")).items()]))
    return (df.withColumns(join_keys(low, high, whole, spread))
            .join(known, ["_low", "_high", "_whole"], "left_anti").select(*columns))


def rewrite_alias(df: DataFrame, columns: Sequence[str] = _SIDE_COLUMNS,
                  aliases: Mapping[str, str] = ALIASES, where: Column | None = None) -> DataFrame:
    """Replace each alias wherever it occurs in the columns, in the rows of `where` only."""
    out = {c: replace_all(c, aliases) for c in columns}
    if where is not None:
        out = {c: F.when(where, new).otherwise(F.col(c)) for c, new in out.items()}
    return df.withColumns(out)


def _struct(fields: Mapping[str, str]) -> str:
    """SQL of a struct with the given expressions by field name."""
    return "struct(" + ", ".join(f"{sql} AS {quoted(n)}" for n, sql in fields.items()) + ")"


def mirror_pairs(df: DataFrame, swaps: Sides = SIDES) -> DataFrame:
    """Every row, and its copy with the swapped columns exchanged, from one pass."""
    other = {a: b for s in swaps for a, b in (s, s[::-1])}
    copies = [_struct({c: quoted(names.get(c, c)) for c in df.columns}) for names in ({}, other)]
    return df.selectExpr(f"inline(array({', '.join(copies)}))")


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of labelled frames. One without priorities gets its position as such."""
    return union_conformed([f if "priority" in f.columns else f.withColumn("priority", F.lit(i))
                            for i, f in enumerate(frames)], LABELLED)


def _by_position(frames: Sequence[Family]) -> DataFrame:
    placed, position = [], 0
    for frame in frames:
        if isinstance(frame, DataFrame):
            placed.append(frame.withColumn("priority", F.lit(position)))
            position += 1
            continue
        rows, (first, *others) = frame
        place = F.when(first, F.lit(position))
        for i, condition in enumerate(others, position + 1):
            place = place.when(condition, F.lit(i))
        placed.append(rows.withColumn("priority", place.otherwise(F.lit(-1))).where("priority >= 0"))
        position += 1 + len(others)
    return combine(placed)


def combine_matches(frames_in_priority_order: Sequence[Family]) -> DataFrame:
    """Union of match families; the position of its frame is a row's priority.

    Families that are cut from one frame may be given as that frame and their conditions, in order,
    each of which takes a position. The frame is then computed once for all of them. A row belongs
    to the first family whose condition holds, and to none otherwise.
    """
    return _by_position(frames_in_priority_order)


def combine_rejects(frames: Sequence[DataFrame],
                    aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rejected pairs of all frames, one row per join-key pair. `aliases`: as in `dedupe_pairs`."""
    return dedupe_pairs(_by_position(frames), order=("priority", "match_timestamp"),
                        aliases=aliases)


_STORES = ("base_source_store", "comp_source_store")


def settle_pairs(labelled: DataFrame, prune: bool = False, undirected: bool = False,
                 derive_stores: bool = False) -> DataFrame:
    """Surviving matches and rejects of labelled pairs, from a single aggregation.

    The rows are those of `dedupe_pairs` on matches and on rejects; when undirected, with the
    sides turned into order. `derive_stores` says that the stores are those of the uuids, so that
    they can be built again afterwards instead of being shuffled.
    """
    payload = [c for c in LABELLED.names
               if c not in JOIN_KEYS and not (derive_stores and c in _STORES)]
    settled = (_settle_pruned if prune else _settle)(labelled, payload, undirected)
    return (add_stores(settled) if derive_stores else settled).select(*PAIR.names)


def _is_reject() -> Column:
    return F.coalesce(F.col("type") == REJECT, F.lit(False))


def _settle(labelled: DataFrame, payload: Sequence[str], undirected: bool) -> DataFrame:
    """One survivor to each pair of keys, as match and as reject."""
    columns = [*JOIN_KEYS, *payload]
    pairs = labelled.select(*columns)
    if undirected:
        pairs = orient_pairs(pairs, sides=[s for s in SIDES if s[0] in columns])
    best = F.min(F.struct(*_ranked(("priority", "match_timestamp"), payload)))
    groups = pairs.groupBy(*_hash_first(pairs, JOIN_KEYS), _is_reject().alias("_reject")).agg(best.alias("_best"))
    return groups.select(*JOIN_KEYS, *[F.col("_best")[c].alias(c) for c in payload])


def _settle_pruned(labelled: DataFrame, payload: Sequence[str], undirected: bool) -> DataFrame:
    """Survivors without the matches that are also rejected, in either direction.

    Both directions of a pair, as match and as reject, meet in the group of its ordered keys;
    the group keeps one survivor for each of the four cases (two when undirected). So pruning
    needs no join: the verdict lies in the same group.
    """
    a, b = JOIN_KEYS
    turn = turned(a, b)
    pairs = labelled.select(
        F.when(turn, F.col(b)).otherwise(F.col(a)).alias("_low"),
        F.when(turn, F.col(a)).otherwise(F.col(b)).alias("_high"),
        turn.alias("_turned"), *payload)
    if undirected:
        pairs = pairs.withColumns(
            {**_swapped(F.col("_turned"), [s for s in SIDES if s[0] in payload]),
             "_turned": F.lit(False)})

    row = F.struct(*_ranked(("priority", "match_timestamp"), payload))
    is_reject = _is_reject()
    kinds = {"match": ~is_reject, "reject": is_reject}
    directions = {"forward": ~F.col("_turned"), "back": F.col("_turned")}
    if undirected:
        del directions["back"]
    groups = pairs.groupBy(*_hash_first(pairs, ("_low", "_high"))).agg(*[
        F.min(F.when(kind & direction, row)).alias(f"{k}_{d}")
        for k, kind in kinds.items() for d, direction in directions.items()])

    rejected = " OR ".join(f"reject_{d} IS NOT NULL" for d in directions)
    kept = {"match": f"NOT (({rejected}) AND _low IS NOT NULL AND _high IS NOT NULL)",
            "reject": "true"}
    survivors = []
    for k, keep in kept.items():
        for d in directions:
            low, high = ("_low", "_high") if d == "forward" else ("_high", "_low")
            row = _struct({c: {a: low, b: high}.get(c, f"{k}_{d}.{quoted(c)}")
                           for c in (*JOIN_KEYS, *payload)})
            survivors.append(f"CASE WHEN {k}_{d} IS NOT NULL AND {keep} THEN {row} END")
    return (groups.selectExpr(f"array({', '.join(survivors)}) AS _rows")
            .selectExpr("inline(array_compact(_rows))"))
