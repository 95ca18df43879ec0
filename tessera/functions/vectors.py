"""Dense-vector column expressions on ``array<double>`` (G4 and helpers).

All are built-in higher-order functions (JVM side).  Arguments may be
columns or Python sequences (turned into array literals: model-sized only).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def vec(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.array(*[F.lit(float(x)) for x in v])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(vec(a), vec(b), lambda x, y: x * y))


def norm2(a) -> Column:
    return F.sqrt(dot(a, a))


def sqdist(a, b) -> Column:
    return _sum(F.zip_with(vec(a), vec(b), lambda x, y: (x - y) * (x - y)))


def l2(a, b) -> Column:
    return F.sqrt(sqdist(a, b))


def l1(a, b) -> Column:
    return _sum(F.zip_with(vec(a), vec(b), lambda x, y: F.abs(x - y)))


def linf(a, b) -> Column:
    return F.array_max(F.zip_with(vec(a), vec(b), lambda x, y: F.abs(x - y)))


def lp(a, b, p: float) -> Column:
    return F.pow(_sum(F.zip_with(vec(a), vec(b), lambda x, y: F.pow(F.abs(x - y), F.lit(p)))),
                 F.lit(1.0 / p))


def cosine(a, b) -> Column:
    """Cosine similarity (cheat-sheet definition); 0 if a vector is zero."""
    den = norm2(a) * norm2(b)
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def angle(a, b) -> Column:
    """Angle in radians, clipped to [0, pi]."""
    c = cosine(a, b)
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), c)))


def mahalanobis_diag(a, b, var) -> Column:
    """sqrt(sum (a_i-b_i)^2 / var_i): Mahalanobis with a diagonal covariance."""
    t = F.zip_with(F.zip_with(vec(a), vec(b), lambda x, y: (x - y) * (x - y)), vec(var),
                   lambda s, v: s / v)
    return F.sqrt(_sum(t))


def scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(vec(a), lambda x: x * s)


def add(a, b) -> Column:
    return F.zip_with(vec(a), vec(b), lambda x, y: x + y)


def outer_flat(a, b) -> Column:
    """Row-major flattened outer product a b^T (small d only)."""
    return F.flatten(F.transform(vec(a), lambda x: F.transform(vec(b), lambda y: x * y)))


def mat_vec_rows(rows: Sequence[Sequence[float]], x) -> Column:
    """W x for a literal matrix W (list of rows)."""
    return F.array(*[dot(list(r), x) for r in rows])
