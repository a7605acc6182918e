"""Embedding whitening: projections on the covariance's eigenvectors, each scaled to variance 1.

A component c becomes the whole number x = floor(scale * c) + shift. The covariance is that of the
different x vectors, each once. Tasks sum whole numbers only: first the components, then the
products of components less their rounded means; what rounding left is taken out of the sums as an
exact fraction. So the covariance has no rounding error but the last, and does not depend on how
rows are dealt to tasks. A task sends one row to a pair of dimensions. The driver holds the matrix,
whose size is the square of the vectors' length, and finds its eigenvectors (`eigen`).

Vectors that are null, empty, or hold a null or non-finite component take no part. Vectors must have
one length, else an error is raised. Repeated rows count once in the fit and are each returned, also
those whose id is null or repeats. Components with no variance (eigenvalue at most 2**-50 of the
largest times the length, as with fewer different vectors than dimensions) have explained 0 and a
null whitened, which then has no covariance; explained is null if there is no variance at all, and
identity_error is null if there is no component left to measure. Components beyond 2**40 after
scaling saturate there; a deviation beyond 38 digits is null. An empty table gives an empty result.
Only the id and the vector are read, and other columns' names do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.scratch import scratch_dir

from .eigen import eigenvectors
from .vector_codes import matrix, one_length, whole_components

SCALE = 64.0
SHIFT = 1_000_000
COMPONENTS = 16
_LIMIT = float(1 << 40)
_EXACT = 2.0 ** 53
_NONE = 2.0 ** -50


def _cross(x: np.ndarray) -> np.ndarray:
    """x'x of whole numbers, as Python's whole numbers."""
    largest = float(np.abs(x).max(initial=0))
    if largest * largest * len(x) < _EXACT:
        wide = x.astype(float)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = x.astype(object)
    return wide.T @ wide


def _whole_sums(vectors: DataFrame, partial) -> dict[tuple[int, int], int]:
    """Sums over all tasks of the upper half of `partial(matrix of a batch)`, by row and column."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(matrix(batch.column("vector")))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total), m=total.shape[1])
            yield pa.RecordBatch.from_pydict({
                "i": i.astype(np.int32), "j": j.astype(np.int32),
                "total": pa.array([int(t) for t in total[i, j]], pa.decimal128(38, 0))})

    rows = vectors.select("vector").mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy(
        "i", "j").agg(F.sum("total").alias("total")).collect()
    return {(r.i, r.j): int(r.total) for r in rows}


@dataclass
class Whitening:
    """A fit on n different vectors, which are taken without a shift of all components."""

    n: int
    means: np.ndarray           # of the components, rounded
    left: np.ndarray            # n times the rest of each mean
    values: np.ndarray          # eigenvalues, falling
    basis: np.ndarray           # their unit eigenvectors, as columns
    varied: np.ndarray          # which have variance
    explained: list
    identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The components with variance of each vector."""
        left = (self.left / self.n).astype(float)
        scaled = self.basis[:, self.varied] / np.sqrt(self.values[self.varied])
        return ((x - self.means).astype(float) - left) @ scaled

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - sum) ** 2, exact."""
        x = x - self.means
        largest = self.n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in self.left)
        kind = np.int64 if largest ** 2 * x.shape[1] < 1 << 62 else object
        far = self.n * x.astype(kind) - self.left.astype(kind)
        return [int(d) for d in (far * far).sum(1)]


def _covariance(vectors: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rounded means, n times the rest of the means, and the covariance in extended precision."""
    sums = _whole_sums(vectors, lambda x: x.sum(0).astype(object)[None, :])
    sums = np.array([sums[0, d] for d in range(len(sums))], object)
    means = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    left = sums - n * means.astype(object)
    covariance = np.empty((len(sums), len(sums)), np.longdouble)
    for (i, j), total in _whole_sums(vectors, lambda x: _cross(x - means)).items():
        exact = n * total - left[i] * left[j]
        covariance[i, j] = covariance[j, i] = np.longdouble(exact) / np.longdouble(n * n)
    return means, left, covariance


def _identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity, measured.

    Tasks' sums are added as decimals, so that their order does not matter.
    """
    k = int(model.varied.sum())
    if not k:
        return None

    def run(batches):
        total = np.zeros((k, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(matrix(batch.column("vector")))
                total += np.column_stack([w.T @ w, w.sum(0)])
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "total": total.ravel()})

    rows = vectors.select("vector").mapInArrow(run, "i int, j int, total double").groupBy(
        "i", "j").agg(F.sum(F.col("total").cast("decimal(38,18)")).alias("total")).collect()
    total = np.zeros((k, k + 1))
    for r in rows:
        total[r.i, r.j] = float(r.total) / model.n
    means = total[:, k]
    return float(np.abs(total[:, :k] - np.outer(means, means) - np.eye(k)).max())


def _valid(table: DataFrame, vector_col: str, scale: float, *others) -> DataFrame:
    return table.select(*others, whole_components(F.col(vector_col), scale, _LIMIT).alias(
        "vector")).where("vector is not null")


def fit(table: DataFrame, *, components: int = COMPONENTS, scale: float = SCALE,
        vector_col: str = "embedding") -> Whitening | None:
    """The whitening of the table's different vectors; None if there are none."""
    spark = table.sparkSession
    path = f"{scratch_dir(spark, 'whitening')}/vectors"
    _valid(table, vector_col, scale).distinct().write.parquet(path)
    vectors = spark.read.parquet(path)
    length = one_length(vectors)
    if length is None:
        return None
    n = vectors.count()
    means, left, covariance = _covariance(vectors, n)
    values, basis = eigenvectors(covariance)
    trace, k = covariance.trace(), min(components, length)
    varied = values[:k] > _NONE * length * values[0]
    explained = [float(v / trace) if some else 0.0 if trace > 0 else None
                 for v, some in zip(values[:k], varied)]
    model = Whitening(n, means, left, values[:k].astype(float), basis[:, :k].astype(float), varied,
                      explained)
    model.identity_error = _identity_error(vectors, model)
    return model


def whiten(table: DataFrame, *, components: int = COMPONENTS, scale: float = SCALE,
           shift: int = SHIFT, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """A row to each vector and component: id_col, component, n, deviation, whitened, explained,
    identity_error.

    shift moves all vectors alike, so that it changes none of these columns.
    """
    model = fit(table, components=components, scale=scale, vector_col=vector_col)
    rows = _valid(table, vector_col, scale, F.col(id_col).alias("id"))
    kind = dict(rows.dtypes)["id"]
    schema = (f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    renamed = {"id": id_col}
    if model is None:
        return table.sparkSession.createDataFrame([], schema).withColumnsRenamed(renamed)
    limit = 10 ** 38

    def run(batches):
        k = len(model.values)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                x = matrix(part.column("vector"))
                whitened = np.full((len(x), k), np.nan)
                whitened[:, model.varied] = model.whitened(x)
                row = np.repeat(np.arange(len(x)), k)
                deviation = pa.array([d if d < limit else None for d in model.deviations(x)],
                                     pa.decimal128(38, 0))
                flat = whitened.ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(row), model.n)), deviation.take(pa.array(row)),
                     pa.array(flat, mask=np.isnan(flat)),
                     pa.array(model.explained * len(x), pa.float64()),
                     pa.array([model.identity_error] * len(row), pa.float64())],
                    schema=pa.schema([("id", part.schema.field("id").type),
                                      ("component", pa.int32()), ("n", pa.int64()),
                                      ("deviation", pa.decimal128(38, 0)),
                                      ("whitened", pa.float64()), ("explained", pa.float64()),
                                      ("identity_error", pa.float64())]))

    return rows.mapInArrow(run, schema).withColumnsRenamed(renamed)
