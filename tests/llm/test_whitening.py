"""Whitening against whole numbers of any size and numpy's eigenvectors."""

import math

import numpy as np
import pytest

from pairloom.llm import queries, whitening
from pairloom.llm.eigen import eigenvectors, product

SCHEMA = "vec_id bigint, embedding array<float>"


def rotated(values, seed=0):
    """A symmetric matrix of the given eigenvalues, in extended precision."""
    values = np.sort(np.array(values, np.longdouble))[::-1]
    n = len(values)
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))
    basis = basis.astype(np.longdouble)
    for _ in range(3):
        basis = basis + basis @ (np.eye(n) - basis.T @ basis) / 2
    matrix = (basis * values) @ basis.T
    return (matrix + matrix.T) / 2, values, basis


@pytest.mark.parametrize("values", [
    np.linspace(20, 112, 64), [1 + 1e-9 * i for i in range(40)],
    [1 + 1e-12 * i for i in range(10)] + list(np.linspace(.1, .5, 20)),
    [1] * 10 + [0.5] * 10, [1, 1 + 1e-7, 1 + 2e-7, 1 + 1e-6, .3, .3000001, .1, .1, .1],
    [10.0 ** -i for i in range(8)], [1] + [0] * 9, [7.0], [0, 0]])
def test_eigenvectors_of_clusters(values):
    matrix, values, _ = rotated(values)
    found, basis = eigenvectors(matrix)
    scale = max(values.max(), np.longdouble(1e-300))
    assert np.abs(found - values).max() <= 1e-17 * scale
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-17
    assert np.abs(matrix @ basis - basis * found).max() <= 1e-17 * scale


def test_near_eigenvalues_are_told_apart():
    matrix, _, basis = rotated([1 + 1e-9 * i for i in range(40)])
    _, found = eigenvectors(matrix)
    assert np.abs(np.abs((found * basis).sum(0)) - 1).max() < 1e-15
    # float32 alone cannot tell any of them apart.
    _, start = np.linalg.eigh(matrix.astype(np.float32))
    assert np.abs((start[:, ::-1] * basis).sum(0)).min() < 0.9


def test_product_is_wide():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 40)).astype(np.longdouble) + rng.normal(size=(30, 40)) * 1e-17
    b = rng.normal(size=(40, 20)).astype(np.longdouble) + rng.normal(size=(40, 20)) * 1e-17
    assert np.abs(product(a, b) - a @ b).max() < 1e-17


def plain(rows, scale=64, shift=1_000_000):
    """n, {x: deviation}, covariance and means of the different vectors, with whole numbers."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) + shift for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    once = sorted({tuple(x) for _, x in kept})
    n, dims = len(once), range(len(once[0]))
    sums = [sum(x[d] for x in once) for d in dims]
    wide = [[n * x[d] - sums[d] for d in dims] for x in once]
    covariance = np.array([[sum(w[i] * w[j] for w in wide) / n ** 3 for j in dims] for i in dims])
    deviation = {x: sum(d * d for d in w) for x, w in zip(once, wide)}
    return kept, n, deviation, covariance, [s / n for s in sums]


def check(rows, found, components=16):
    kept, n, deviation, covariance, means = plain(rows)
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, len(values))
    assert len(found) == k * len(kept)
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    whitened = np.empty((len(kept), k))
    for place, (i, x) in enumerate(kept):
        own = by_row[i]
        assert sorted(own) == list(range(1, k + 1))
        for c, r in own.items():
            assert (r.n, r.deviation) == (n, deviation[tuple(x)])
            assert r.explained == pytest.approx(values[c - 1] / covariance.trace(), rel=1e-10)
            assert r.identity_error < 1e-9
            whitened[place, c - 1] = r.whitened
    want = (np.array([x for _, x in kept]) - means) @ basis[:, :k] / np.sqrt(values[:k])
    signs = np.sign((want * whitened).sum(0))
    assert np.abs(whitened * signs - want).max() < 1e-7


def test_random_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6) * [5, 3, 3, 2, 1, 1] + 9]) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]
    check(rows, whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect())
    few = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=2)
    check(rows, few.collect(), components=2)


def test_partitions_do_not_matter(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    one, many = (sorted(map(tuple, whitening.whiten(frame.repartition(p)).drop(
        "identity_error").collect())) for p in (1, 13))
    assert one == many


def test_awkward_rows(spark):
    rows = [(1, [1.0, 2.0]), (None, [0.5, 9.0]), (2, None), (3, []), (4, [float("nan"), 1.0]),
            (5, [None, 1.0]), (6, [float("-inf"), 1.0]), (7, [4.0, 4.0]), (7, [4.0, 4.0]),
            (8, [-3.0, 0.25])]
    names = ["id", "vector", "n", "i", "j", "total", "component", "whitened"]
    frame = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows],
                                  SCHEMA + "".join(f", `{n}` string" for n in names))
    out = whitening.whiten(frame).collect()
    assert sorted(str(r.vec_id) for r in out if r.component == 1) == ["1", "7", "7", "8", "None"]
    check([r for r in rows if r[0] != 7] + [rows[-2]],
          [r for i, r in enumerate(out) if r.vec_id != 7
           or (r.vec_id, r.component) not in {(s.vec_id, s.component) for s in out[:i]}])


def test_without_variance(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA))
    for r in one.collect():
        assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (
            1, 0, None, None, None)
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], SCHEMA))
    rows = {(r.vec_id, r.component): r for r in line.collect()}
    assert rows[1, 1].whitened == pytest.approx(-rows[2, 1].whitened)
    assert abs(rows[1, 1].whitened) == pytest.approx(1)
    assert rows[1, 2].whitened is None and rows[1, 2].explained == 0
    assert rows[1, 1].explained == pytest.approx(1) and rows[1, 1].identity_error < 1e-12


def test_large_components(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [1e9, -5.0]), (4, [0.0, 0.0])]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    limit = 1 << 40
    x = {1: (limit, 64), 2: (-limit, 128), 3: (64 * 10 ** 9, -320), 4: (0, 0)}
    sums = [sum(v[d] for v in x.values()) for d in range(2)]
    for r in out:
        assert r.deviation == sum((4 * v - s) ** 2 for v, s in zip(x[r.vec_id], sums))
        # The second component's variance is lost beside the first's.
        assert (r.whitened is None) == (r.component == 2)


def test_empty_table_and_unequal_lengths(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="components"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding)
            for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    out = queries.QUERIES["op11_whitening"](spark, sf_dir)
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double"}
    check(rows, out.collect())
