"""Eigenvectors of a symmetric matrix in mixed precision: single-precision start, refinement by matrix products."""

from __future__ import annotations

import numpy as np

#: Rounds of refinement in double, then in extended precision; convergence is quadratic, so most of them are reserve.
ROUNDS = {np.float64: 12, np.longdouble: 4}
#: Eigenvalues closer than this share of the norm are treated as one cluster for as long as the error is no smaller.
CLUSTER = 1e-5


def _defects(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far the vectors are from being orthonormal, the matrix in their basis, and their Rayleigh quotients."""
    off = np.eye(len(matrix), dtype=matrix.dtype) - vectors.T @ vectors
    within = vectors.T @ (matrix @ vectors)
    return off, within, np.diag(within) / (1 - np.diag(off))


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues, falling, in runs whose neighbours are at most ``gap`` apart."""
    order = np.argsort(-values, kind="stable")
    return np.split(order, np.flatnonzero(-np.diff(values[order]) > gap) + 1)


def _turned(within: np.ndarray, off: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The rotation that makes a cluster diagonal: a small problem of its own, shifted so that only differences are left."""
    off, one = off[np.ix_(places, places)], np.eye(len(places), dtype=off.dtype)
    block = within[np.ix_(places, places)]
    # Vectors that are not quite orthonormal: (I - off)^(-1/2) is I + off / 2 up to the square of off.
    half = one + off / 2
    block = half @ (block - np.trace(block) / len(places) * (one - off)) @ half
    scale = float(np.abs(block).max()) or 1.0
    return np.linalg.eigh((block / scale).astype(np.float64))[1].astype(off.dtype)


def _orthonormal(vectors: np.ndarray) -> np.ndarray:
    """The nearest orthonormal vectors, for vectors that are nearly so."""
    for _ in range(2):
        vectors = vectors + vectors @ (np.eye(len(vectors), dtype=vectors.dtype) - vectors.T @ vectors) / 2
    return vectors


def _improved(matrix: np.ndarray, vectors: np.ndarray, rounds: int) -> np.ndarray:
    """Rounds of X + XE in one precision, until the change is down to its rounding or no longer falls.

    E follows from the defects of X: for eigenvalues that are far apart from their quotient, within a cluster only the
    part that makes the vectors orthonormal. Clusters are resolved first, by problems of their own, in ever finer
    clusters as the error falls.
    """
    size, norm = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    tiny, before = float(np.finfo(matrix.dtype).eps) * size, np.inf
    for _ in range(rounds):
        off, within, values = _defects(matrix, vectors)
        error = 2 * (float(np.abs(within - np.diag(values)).max()) + norm * float(np.abs(off).max()))
        gap = min(CLUSTER * norm, max(error * size, tiny * norm))
        clusters = [places for places in _clusters(values, gap) if len(places) > 1]
        for places in clusters:
            vectors[:, places] = vectors[:, places] @ _turned(within, off, places)
        if clusters:
            off, within, values = _defects(matrix, vectors)
        difference = values[None, :] - values[:, None]
        far = np.abs(difference) > gap
        change = np.where(far, (within + values[None, :] * off) / np.where(far, difference, 1), off / 2)
        np.fill_diagonal(change, np.diag(off) / 2)
        step = float(np.abs(change).max())
        if step > 0.5 or step >= before:
            break
        vectors = vectors + vectors @ change
        if step < 4 * tiny:
            break
        before = step
    return _orthonormal(vectors)


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The start is a single-precision decomposition of the matrix over its largest entry, refined in double and last in
    extended precision. Of each vector the entry that is largest by amount is positive, so reruns agree. A matrix of
    zeros has the unit vectors of its axes; entries that are not finite raise.
    """
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.abs(matrix).max())
    if not np.isfinite(scale):
        raise ValueError("the matrix has entries that are not finite")
    if scale == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    vectors = np.linalg.eigh((matrix / scale).astype(np.float32))[1]
    for kind, rounds in ROUNDS.items():
        exact = matrix.astype(kind) / kind(scale)
        vectors = _improved(exact, vectors.astype(kind), rounds)
    values = _defects(exact, vectors)[2]
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(vectors))]
    return (values * scale).astype(np.float64), (vectors * np.where(top < 0, -1, 1)).astype(np.float64)
