"""Codes against codebooks that plain loops move."""

import hashlib
import math

import numpy as np
import pytest

from pairloom.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale):
    """vec_id, code, error, label_error, codebooks_sha256, sorted."""
    kept = []
    for i, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in vector], label))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    least = {}
    for i, v, _ in kept:
        least[i] = min(least.get(i, v), v)
    ids = sorted((i for i in least if i is not None)) + [None] * (None in least)
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[least[i][p * width:(p + 1) * width] for i in ids[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for c in cut]
    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, b in zip(cut, best) if b[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    best = assign()
    errors = [sum(d for d, _ in b) for b in best]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    text = ",".join(str(x) for p in books for e in p for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in b), e, by_label[label], digest)
                   for (i, _, label), b, e in zip(kept, best, errors)), key=str)


def found(spark, rows, schema=SCHEMA, **options):
    out = vector_codes.encode(spark.createDataFrame(rows, schema), **options)
    return sorted(map(tuple, out.select("vec_id", "code", "error", "label_error",
                                        "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("leaves", [1, 3, 2048])
def test_nearest_entries(leaves, monkeypatch):
    monkeypatch.setattr(vector_codes, "_LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    for _ in range(100):
        width = rng.integers(1, 6)
        parts = np.unique(rng.integers(-3, 4, (rng.integers(1, 150), width)), axis=0)
        book = rng.integers(-3, 4, (rng.integers(1, 17), width))
        all_far = ((parts[:, None] - book) ** 2).sum(2)
        entry, least = vector_codes.nearest(parts, book)
        assert (entry == all_far.argmin(1)).all() and (least == all_far.min(1)).all()


def test_random_vectors(spark):
    rng = np.random.default_rng(4)
    # Few values: ties between entries, equal parts, negative means.
    rows = [(int(i), [float(x) for x in rng.integers(-4, 5, 8) / 4], int(i % 3) or None)
            for i in rng.permutation(300)]
    rows += [(500 + i, [0.25] * 8, 7) for i in range(150)]
    options = {"parts": 4, "entries": 5, "rounds": 3, "scale": 10.0}
    assert found(spark, rows, **options) == plain(rows, **options)


def test_awkward_rows(spark):
    rows = [(3, [1.0, 2.0], 1), (3, [0.5, 9.0], None), (None, [4.0, 4.0], 1), (None, [3.0, 8.0], 2),
            (1, None, 1), (2, [], 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1),
            (6, [float("inf"), 1.0], 1), (7, [-1.5, -2.5], None), (7, [-1.5, -2.5], None)]
    options = {"parts": 2, "entries": 16, "rounds": 6, "scale": 4096.0}
    assert found(spark, rows, **options) == plain(rows, **options)


def test_other_columns(spark):
    names = ["id", "vector", "code", "error", "place", "part", "n", "_label", "label_error", "entry"]
    rows = [(i, [i / 7, -i / 3], i % 2, *["x"] * len(names)) for i in range(40)]
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    assert found(spark, rows, schema, parts=2, entries=4) == plain(
        [r[:3] for r in rows], 2, 4, vector_codes.ROUNDS, vector_codes.SCALE)


def test_large_components_saturate(spark):
    rows = [(1, [1e30, 0.0], 1), (2, [-1e30, 0.0], 1)]
    errors = [r[2] for r in found(spark, rows, parts=1, entries=1, rounds=0)]
    assert errors == [0, (1 << 27) ** 2]


def test_empty_table_and_unequal_lengths(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1)]) == []
    with pytest.raises(ValueError, match="components"):
        found(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0, 3.0], 1)], parts=1)
    with pytest.raises(ValueError, match="equal parts"):
        found(spark, [(1, [1.0, 2.0, 3.0], 1)], parts=2)
