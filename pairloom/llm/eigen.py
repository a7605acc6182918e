"""Eigenvectors of a symmetric matrix: a float32 start, corrected by matrix products.

A pass takes the residuals I - X'X and X'AX of the vectors X in extended precision and corrects X
by one more product (Ogita and Aishima); the error is squared. Within a cluster of eigenvalues too
near to be told apart by the residuals, a pass only makes the vectors orthonormal. The cluster is
then solved by itself: its vectors span the right space, and the eigenvectors of the small matrix
X'(A - c)X, c being the cluster's middle, turn them into place.

Products in extended precision are sums of products of short slices, which are exact in doubles.
"""

from __future__ import annotations

import numpy as np

_PASSES = 12
_WIDE = np.longdouble
_BITS = 66
_SMALL = 1e-6


def _slices(matrix: np.ndarray, bits: int, axis: int) -> list[np.ndarray]:
    """Doubles of a few bits each that add up to the matrix; `axis` is summed over later."""
    out, left = [], matrix
    for _ in range(-(-_BITS // bits)):
        most = np.abs(left).max(axis, keepdims=True)
        unit = np.ldexp(_WIDE(1), np.frexp(most)[1] - bits)
        top = np.rint(left / unit) * unit
        out.append(top.astype(float))
        left = left - top
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in extended precision."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), _WIDE)
    bits = (53 - int(np.ceil(np.log2(a.shape[1] + 1)))) // 2
    left, right = _slices(a, bits, 1), _slices(b, bits, 0)
    total = np.zeros((a.shape[0], b.shape[1]), _WIDE)
    for order in reversed(range(len(left))):
        for i in range(order + 1):
            total += left[i] @ right[order - i]
    return total


def _norm(matrix: np.ndarray) -> np.longdouble:
    """A bound of the spectral norm of a symmetric matrix."""
    return np.abs(matrix).sum(1).max()


def _correct(matrix: np.ndarray, vectors: np.ndarray):
    """One pass: better vectors, the size of the correction, eigenvalues, and the distance below
    which they are one cluster."""
    plain = np.eye(len(matrix), dtype=_WIDE) - product(vectors.T, vectors)
    turned = product(vectors.T, product(matrix, vectors))
    values = turned.diagonal() / (1 - plain.diagonal())
    near = 2 * (_norm(turned - np.diag(values)) + _norm(matrix) * _norm(plain))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    change = np.where(apart, (turned + values[None, :] * plain)
                      / np.where(apart, gap, 1), plain / 2)
    return vectors + product(vectors, change), np.abs(change).max(), values, near


def _clusters(values: np.ndarray, near: np.longdouble) -> list[np.ndarray]:
    """Places of neighbouring eigenvalues that are not told apart, two or more to a cluster."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _solve_cluster(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned to the eigenvectors within the space that they span."""
    products = product(matrix, vectors)
    middle = (vectors * products).sum() / (vectors * vectors).sum()
    small = product(vectors.T, products - middle * vectors)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if not size:
        return vectors
    _, turn = np.linalg.eigh((small / size).astype(float))
    return product(vectors, turn.astype(_WIDE))


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, both in extended precision."""
    matrix = np.asarray(matrix, _WIDE)
    scale = np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(len(matrix), _WIDE), np.eye(len(matrix), dtype=_WIDE)
    matrix = matrix / scale
    _, start = np.linalg.eigh(matrix.astype(np.float32))
    vectors, before = start.astype(_WIDE), np.inf
    for _ in range(_PASSES):
        vectors, size, values, near = _correct(matrix, vectors)
        for cluster in _clusters(values, near):
            vectors[:, cluster] = _solve_cluster(matrix, vectors[:, cluster])
        # The error is squared by each pass, until it is as small as rounding lets it be.
        if size < _SMALL and size > before / 2:
            break
        before = size
    for _ in range(2):
        vectors = vectors + product(vectors, np.eye(len(matrix), dtype=_WIDE)
                                    - product(vectors.T, vectors)) / 2
    values = (vectors * product(matrix, vectors)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, vectors[:, order]
