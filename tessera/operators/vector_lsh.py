"""LSH joins on dense vectors (L4-L7, G6).  The exact joins are in
:mod:`tessera.operators.metric_join`.

Hash functions are drawn from md5-keyed normals/uniforms (model-sized, in the
closure).  A batch of vectors is projected by one matrix product and the hash values
of each band are packed into a 64-bit key there, so a plan holds one function however
many bands there are.  Sign bits are packed as they are; bucket numbers are mixed,
and two of them under one key only make a candidate more.

Candidates of dense vectors outnumber the links by far, so they are never rows: a
self-join sends each vector with all its keys to the bucket of each band, where the
candidates are compared by matrix products and only links come out, in the first
band that holds both ends.  What is shuffled grows with vectors x bands; a hot bucket
is cut into tiles (:mod:`tessera.operators.joins`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import gaussian_matrix, uniform_vector
from tessera.operators.joins import DEFAULT_BLOCK, _block, _hot, _look_up, bucket_cross_pairs
from tessera.operators.metric_join import close_pairs, near_pairs
from tessera.operators.partial import matrix
from tessera.session import materialize

#: vectors of a tile of a bucket
TILE = 1 << 14


def project_udf(W: np.ndarray):
    """Arrow-batched projections W x (one NumPy matmul per batch)."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _p(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=object)
        X = np.stack(xs.to_numpy()).astype(np.float64)
        return pd.Series(list(X @ W.T))

    return _p


def with_projections(df: DataFrame, W: np.ndarray, x_col: str = "x", out: str = "_p") -> DataFrame:
    return df.withColumn(out, project_udf(W)(F.col(x_col)))


def keys_udf(W: np.ndarray, r: int, hashes: Callable[[np.ndarray], np.ndarray]):
    """The key of each band of ``r`` hashes.  ``hashes`` turns a batch of projections
    (n x r b) into truth values or integers."""
    bits = W.shape[0] // r

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=object)
        h = hashes(np.stack(xs.to_numpy()).astype(np.float64) @ W.T)
        return pd.Series(list(_packed(h.astype(np.int64).reshape(len(xs), bits, r), h.dtype == bool)))
    return keys


def band_rows(df: DataFrame, W: np.ndarray, r: int, hashes: Callable[[np.ndarray], np.ndarray], id_col: str = "id", out: str = "id") -> DataFrame:
    """``out, band, key``: one row for each vector and band; null vectors have no bands."""
    return (df.where(F.col("x").isNotNull()).withColumn("_keys", keys_udf(W, r, hashes)(F.col("x")))
            .select(F.col(id_col).alias(out), F.posexplode("_keys").alias("band", "key")))


def _packed(h: np.ndarray, bits: bool | None = None) -> np.ndarray:
    """Keys (n x b) of hash values (n x b x r): bits side by side where they fit, else mixed.
    Batches of one table must agree on ``bits``; by default the values tell."""
    if bits is None:
        bits = bool(h.size and h.min() >= 0 and h.max() <= 1)
    if bits and h.shape[2] <= 62:
        return h @ (1 << np.arange(h.shape[2], dtype=np.int64))
    key = np.full(h.shape[:2], 0x9E3779B97F4A7C15, np.uint64)
    for k in range(h.shape[2]):
        key ^= h[:, :, k].view(np.uint64) + np.uint64(0x632BE59BD9B4E019) + (key << np.uint64(6)) + (key >> np.uint64(2))
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return (key >> np.uint64(1)).astype(np.int64)


def bucket_links(points: DataFrame, W: np.ndarray, r: int, hashes: Callable[[np.ndarray], np.ndarray], linked: Callable,
                 name: str, block: int) -> DataFrame:
    """``id_a < id_b, name``: pairs of vectors that share a bucket and that ``linked(A, B, same)``
    yields as (i, j, value), each once: in the first band that holds both.

    Null vectors and vectors without an id link with nothing; repeated rows give repeated pairs.
    """
    p = points.where("id IS NOT NULL AND x IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), F.col("x").cast("array<double>").alias("x"))
    rows = materialize(p.withColumn("keys", keys_udf(W, r, hashes)(F.col("x")))).select("id", "x", "keys", F.posexplode("keys").alias("band", "key"))
    at = ["band", "key"]
    tiles = _look_up(rows, _hot(rows, at, block, "_s"), at, ["_s"]).withColumn("o", _block("id", "_s"))
    tiles = tiles.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_s") - 1))).select(
        *at, F.least("o", "k").alias("ti"), F.greatest("o", "k").alias("tj"), "o", "id", "x", "keys")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        band, ti, tj = (t.column(c)[0].as_py() for c in ("band", "ti", "tj"))
        if len(t) < 2:
            return
        ids, o = np.asarray(t.column("id").combine_chunks()), np.asarray(t.column("o").combine_chunks())
        X = matrix(t.column("x").combine_chunks())
        keys = np.asarray(t.column("keys").combine_chunks().flatten()).reshape(len(ids), -1)[:, :band]
        a, b = np.flatnonzero(o == ti), np.flatnonzero(o == tj)
        for i, j, v in linked(X[a], X[b], ti == tj):
            i, j = a[i], b[j]
            ok = (ids[i] != ids[j]) & ~(keys[i] == keys[j]).any(1)
            i, j = ids[i[ok]], ids[j[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(v[ok])], names=["id_a", "id_b", name])
    return tiles.groupBy(*at, "ti", "tj").applyInArrow(compare, f"id_a bigint, id_b bigint, {name} double")


def _dimension(points: DataFrame) -> int:
    first = points.where("x IS NOT NULL").select("x").first()
    return len(first["x"]) if first else 0


# ------------------------------------------------------------------ bands from the recall
def cosine_agreement(cosine: float) -> float:
    """Chance that a sign bit agrees on two vectors of the given cosine."""
    return 1 - math.acos(cosine) / math.pi


def euclidean_agreement(dist: float, a: float, dim: int) -> float:
    """Chance that a cell of width ``a`` on a random unit direction of ``dim``
    dimensions holds both of two points at the given distance."""
    t = a * math.sqrt(dim) / dist
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def bands_for_recall(p: float, r: int, recall: float) -> int:
    """Bands of r hashes that find a pair whose hashes agree with chance p with the given recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - p ** r))


# ------------------------------------------------------------------ L4
def cosine_lsh_pairs(points: DataFrame, r: int, b: int, threshold: float, seed: int, block: int = TILE) -> DataFrame:
    """Random-hyperplane LSH: bands of r sign bits (1 when w.x >= 0), candidates, cosine >= threshold."""
    def unit(X):
        n = np.sqrt((X * X).sum(1))
        return X / np.where(n > 0, n, 1.0)[:, None]

    def linked(A, B, same):
        for i, j, v in near_pairs(A, B, lambda P, Q: unit(P) @ unit(Q).T >= threshold - 1e-9, cosines, same):
            ok = v >= threshold
            yield i[ok], j[ok], v[ok]
    return bucket_links(points, gaussian_matrix(r * b, _dimension(points), seed, "cos"), r, lambda p: p >= 0, linked, "cosine", block)


def cosines(A: np.ndarray, B: np.ndarray) -> np.ndarray:
    """Cosine of each row of A with that of B (0 with a zero vector)."""
    den = np.sqrt((A * A).sum(1)) * np.sqrt((B * B).sum(1))
    return np.where(den > 0, (A * B).sum(1) / np.where(den > 0, den, 1.0), 0.0)


def pair_metric_udf(metric: str):
    """Arrow-batched cosine similarity or l2 distance of two array columns."""

    @F.pandas_udf(T.DoubleType())
    def _m(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=float)
        A = np.stack(a.to_numpy()).astype(np.float64)
        Bm = np.stack(b.to_numpy()).astype(np.float64)
        if metric == "cosine":
            return pd.Series(cosines(A, Bm))
        D = A - Bm
        return pd.Series(np.sqrt((D * D).sum(1)))

    return _m


# ------------------------------------------------------------------ L5 / L6
def _e2lsh(d: int, r: int, b: int, a: float, seed: int):
    """Directions, and floor((w.x + b)/a) of projections: w standard normal, normalised, b in [0, a)."""
    W = gaussian_matrix(r * b, d, seed, "e2")
    shift = a * uniform_vector(r * b, seed, "e2b")
    return W / np.linalg.norm(W, axis=1, keepdims=True), lambda p: np.floor((p + shift) / a)


def euclidean_lsh_pairs(points: DataFrame, r: int, b: int, a: float, radius: float, seed: int, block: int = TILE) -> DataFrame:
    """p-stable (Gaussian) LSH for l2: bands of r bucket indices, verify d <= radius."""
    W, hashes = _e2lsh(_dimension(points), r, b, a, seed)
    return bucket_links(points, W, r, hashes, lambda A, B, same: close_pairs(A, B, radius, same), "l2", block)


def near_neighbors(queries: DataFrame, base: DataFrame, r: int, b: int, a: float, radius: float,
                   seed: int, eps: float = 0.0, block: int = DEFAULT_BLOCK) -> DataFrame:
    """(radius, eps) neighbours of each query, found through shared Euclidean-LSH
    buckets: base points within ``radius`` (with the recall of the bands), and none
    beyond ``(1 + eps) radius``; points between the two come if they are candidates."""
    W, hashes = _e2lsh(len(base.select("x").first()["x"]), r, b, a, seed)
    qrows = materialize(band_rows(queries, W, r, hashes, out="qid"))
    brows = band_rows(base, W, r, hashes)
    cands = bucket_cross_pairs(qrows, brows, ["band", "key"], "qid", "id", block).distinct()
    q = queries.select(F.col("id").alias("qid"), F.col("x").alias("qx"))
    j = cands.join(q, "qid").join(base.select("id", "x"), "id")
    return j.select("qid", "id", pair_metric_udf("l2")(F.col("qx"), F.col("x")).alias("l2")) \
        .where(F.col("l2") <= (1 + eps) * radius)


# ------------------------------------------------------------------ L7
def hyperplane_lsh_candidates(points: DataFrame, w: np.ndarray, tables: int, seed: int) -> DataFrame:
    """2-bit hash [sgn(u.x), sgn(v.x)] for points, [sgn(u.w), -sgn(v.w)] for
    the query hyperplane w; points colliding in any table are candidates for
    lying near the hyperplane.  The query side is one row, so candidates are
    a filter, not a join."""
    d = len(w)
    U = gaussian_matrix(tables, d, seed, "hu")
    Vm = gaussian_matrix(tables, d, seed, "hv")

    def sg(v: float) -> int:
        return 1 if v >= 0 else 0

    conds = []
    UV = np.vstack([U, Vm])
    for t in range(tables):
        qu, qv = sg(float(U[t] @ w)), 1 - sg(float(Vm[t] @ w))
        pu = F.when(F.element_at("_p", t + 1) >= 0, 1).otherwise(0)
        pv = F.when(F.element_at("_p", tables + t + 1) >= 0, 1).otherwise(0)
        conds.append((pu == qu) & (pv == qv))
    hit = conds[0]
    for c in conds[1:]:
        hit = hit | c
    return with_projections(points, UV).where(hit).drop("_p")


# ------------------------------------------------------------------ G6
def collision_probability(s: Column, r: int, b: int) -> Column:
    """1 - (1 - s^r)^b (AND of r rows, OR of b bands)."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(s, F.lit(float(r))), F.lit(float(b)))


def cascade_probability(s: Column, stages: list[tuple[str, int]]) -> Column:
    """G6 cascades: apply ('and', r) -> p^r and ('or', b) -> 1-(1-p)^b in order."""
    p = s
    for kind, n in stages:
        p = F.pow(p, F.lit(float(n))) if kind == "and" else F.lit(1.0) - F.pow(F.lit(1.0) - p, F.lit(float(n)))
    return p

