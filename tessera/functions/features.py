"""Feature maps as column expressions (B5, B6, B7, G8 and helpers)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.vectors import vec

SQRT2 = math.sqrt(2.0)


def poly2(x) -> Column:
    """Degree-2 map of the reference: row-major d x d, diagonal x_i^2,
    off-diagonal sqrt(2) x_i x_j in *both* triangles (so <poly2(x), poly2(y)>
    = 2 (x.y)^2 - sum x_i^2 y_i^2)."""
    x = vec(x)
    return F.flatten(F.transform(x, lambda xi, i: F.transform(
        x, lambda xj, j: xi * xj * F.when(i == j, F.lit(1.0)).otherwise(F.lit(SQRT2)))))


def poly2_weights_matrix(w: np.ndarray, d: int) -> np.ndarray:
    """Fold a poly2-space weight vector into M with w . poly2(x) = x^T M x."""
    N = np.full((d, d), SQRT2)
    np.fill_diagonal(N, 1.0)
    return w.reshape(d, d) * N


def poly2_np(X: np.ndarray) -> np.ndarray:
    """NumPy twin of :func:`poly2` for Arrow batches (n x d -> n x d^2)."""
    n, d = X.shape
    N = np.full((d, d), SQRT2)
    np.fill_diagonal(N, 1.0)
    return (X[:, :, None] * X[:, None, :] * N[None]).reshape(n, d * d)


def concat_features(a, b) -> Column:
    """``[a || b]``."""
    return F.concat(vec(a), vec(b))


def interaction_features(user, article) -> Column:
    """Flattened outer(user, article), row-major (user index outer)."""
    u, a = vec(user), vec(article)
    return F.flatten(F.transform(u, lambda ui: F.transform(a, lambda aj: ui * aj)))


def rff(x, W: np.ndarray, b: np.ndarray) -> Column:
    """Random Fourier features sqrt(2/m) cos(W x + b) for a literal W (m x d)."""
    m = W.shape[0]
    xs = vec(x)
    c = math.sqrt(2.0 / m)
    feats = []
    for i in range(m):
        wi = F.array(*[F.lit(float(v)) for v in W[i]])
        dotc = F.aggregate(F.zip_with(xs, wi, lambda p, q: p * q), F.lit(0.0), lambda acc, t: acc + t)
        feats.append(F.lit(c) * F.cos(dotc + F.lit(float(b[i]))))
    return F.array(*feats)
