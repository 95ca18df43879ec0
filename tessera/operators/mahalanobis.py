"""Mahalanobis norms ||G w|| with a full matrix.

G is model-sized (d x d): it travels in the closure and is applied to a batch of
rows as one matrix product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.partial import moments

MAX_SIDE = 8_192  # d: G has at most d x d doubles (512 MB)


def whitening(df: DataFrame, x: str = "x", ridge: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, G) such that ||G (x - mean)|| is the Mahalanobis distance under the covariance
    of the vectors (plus ``ridge`` on its diagonal).

    The covariance comes from one distributed pass; G is the inverse of its Cholesky
    factor.  A covariance that is not positive definite raises: give a ridge.
    """
    n, mean, cov = moments(df, x)
    if n == 0:
        raise ValueError("no vectors")
    if len(mean) > MAX_SIDE:
        raise ValueError(f"{len(mean)} dimensions exceed the model size bound")
    L = np.linalg.cholesky(cov + ridge * np.eye(len(mean)))
    return mean, np.linalg.solve(L, np.eye(len(mean)))


def mahalanobis(df: DataFrame, G: np.ndarray, x: str = "x", center: np.ndarray | dict[int, np.ndarray] | None = None,
                by: str | None = None, out: str = "norm") -> DataFrame:
    """``df`` with ``out`` = ||G (x - centre)||.

    ``center`` is one vector, or a vector for each value of the integer column ``by``;
    a null vector, or a row whose centre is missing, gives null.
    """
    if max(G.shape) > MAX_SIDE:
        raise ValueError("G exceeds the model size bound")
    keys = np.array(sorted(center) if isinstance(center, dict) else [0])
    C = np.array([center[k] for k in keys.tolist()] if isinstance(center, dict) else [np.zeros(G.shape[1]) if center is None else center], dtype=np.float64)

    @F.pandas_udf("double")
    def norm(xs: pd.Series, key: pd.Series) -> pd.Series:
        res = pd.Series([None] * len(xs), dtype=object)
        k = key.to_numpy(dtype=np.float64, na_value=np.nan)
        at = np.searchsorted(keys, k).clip(0, len(keys) - 1)
        ok = np.flatnonzero(xs.notna().to_numpy() & (keys[at] == k))
        if len(ok):
            w = np.stack(xs.iloc[ok].to_numpy()).astype(np.float64) - C[at[ok]]
            res.iloc[ok] = np.sqrt(((w @ G.T) ** 2).sum(1))
        return res.astype("float64")
    return df.withColumn(out, norm(F.col(x), F.col(by).cast("double") if by else F.lit(0.0)))
