"""Latent semantic vectors: document frequencies and a distributed randomised SVD.

The SVD of a TF-IDF matrix A (rows: texts or passages, columns: hashed features) needs one
pass: every task adds up its part of C = AᵀAΩ for a fixed random Ω, a tree of tasks adds the
parts, and the driver, which only ever holds columns x rank numbers, turns C into the leading
right singular vectors and singular values (Nyström form of the randomised SVD).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame


def sum_arrays(parts: DataFrame, size: int, depth: int = 3) -> np.ndarray:
    """Sum of float64 arrays of ``size`` numbers, one binary value per row, by a tree of tasks."""

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + b

    arrays = parts.rdd.map(lambda row: np.frombuffer(row[0], np.float64))
    return arrays.treeAggregate(np.zeros(size), add, add, depth)


def random_basis(columns: int, rank: int, seed: int = 11) -> np.ndarray:
    """Ω: orthonormal columns, the same everywhere for one seed."""
    drawn = np.random.default_rng(seed).standard_normal((columns, rank))
    return np.linalg.qr(drawn)[0]


def right_singular(product: np.ndarray, basis: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(V, singular values) of A from AᵀAΩ; directions without weight are left out."""
    shift = np.finfo(np.float64).eps * max(1.0, float(np.linalg.norm(product)))
    shifted = product + shift * basis
    inner = basis.T @ shifted
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > values.max() * 1e-10
    half = (shifted @ vectors[:, good]) / np.sqrt(values[good])
    left, singular, _ = np.linalg.svd(half, full_matrices=False)
    power = np.maximum(singular**2 - shift, 0.0)
    keep = (power > power.max() * 1e-10)[:rank] if len(power) else []
    return left[:, :rank][:, keep], np.sqrt(power[:rank][keep])


def idf_of(frequencies: np.ndarray, rows: float) -> np.ndarray:
    return np.log((1.0 + rows) / (1.0 + frequencies))
