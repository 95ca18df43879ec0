"""Exact distance joins by metric pivots.

Random projections cannot prune at radii near the data's own spread; distances to
pivots can, wherever the data have clusters.  A few pivots, spread out among a
sample, divide the points into cells of the nearest pivot.  By the triangle
inequality a point can only be within ``eps`` of points of cell j if

    d(x, p_j) <= R_j + eps            (R_j: the cell's largest distance to its pivot)
    d(x, p_j) <= d(x, own pivot) + 2 eps

so it visits just those cells (of two cells the lower sends its points to the
higher, so a pair meets once).  Inside a cell, points lie in rings of width ``eps``
around the pivot; only equal and neighbouring rings can hold pairs.  What is left is
compared in blocks, with the vectors at hand; crowded rings are cut into tiles, so a
task sees at most two tiles, strip by strip.  A row is sent once for each tile of its
bucket, so tiles are as large as a task can hold.  Nothing is lost and nothing is
verified twice.

Null vectors, and vectors without an id, are near nothing.  All vectors have one length.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import HOT_ROWS
from tessera.operators.partial import matrix
from tessera.operators.sampling import uniform_sample
from tessera.session import materialize

#: rows of a tile
TILE = 1 << 15
#: rows of a tile that are compared with another tile at once, and pairs that are verified at once
STRIP, LOT = 128, 1 << 16
#: points from which the pivots are chosen
SAMPLE = 1_024


def choose_pivots(points: DataFrame, n: int, seed: int) -> np.ndarray:
    """n spread-out vectors of a bounded sample: each next one is the farthest from those chosen."""
    rows = sorted(uniform_sample(points.where("x IS NOT NULL").select("id", "x"), SAMPLE, seed, "id").select("id", "x").collect(), key=lambda r: r["id"])
    X = np.array([r["x"] for r in rows], dtype=np.float64)
    if not len(X):
        return X
    chosen = [0]
    far = ((X - X[0]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((X - X[chosen[-1]]) ** 2).sum(1))
    return X[chosen]


def _distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    out = np.empty((len(X), len(P)))
    step = max(1, (1 << 22) // max(1, P.size))
    for s in range(0, len(X), step):
        diff = X[s:s + step, None, :] - P[None]
        out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _radii(points: DataFrame, P: np.ndarray) -> np.ndarray:
    """Largest distance of a cell's points to its pivot (-inf for an empty cell)."""
    def run(batches):
        best = np.full(len(P), -np.inf)
        for b in batches:
            if b.num_rows:
                D = _distances(matrix(b.column(0)), P)
                home = D.argmin(1)
                np.maximum.at(best, home, D[np.arange(len(D)), home])
        at = np.flatnonzero(best >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best[at])], names=["cell", "r"])
    got = points.where("x IS NOT NULL").select("x").mapInArrow(run, "cell int, r double").groupBy("cell").agg(F.max("r").alias("r")).collect()
    out = np.full(len(P), -np.inf)
    for r in got:
        out[r["cell"]] = r["r"]
    return out


#: roles of a row in a bucket: a resident meets residents and everybody else; guests (of
#: the ring below) and visitors (of another cell) do not meet each other
PLACED = "cell int, ring int, lower boolean, home boolean, id bigint, x array<double>"


def _placed(points: DataFrame, P: np.ndarray, R: np.ndarray, eps: float, queries: bool | None = None) -> DataFrame:
    """Rows of each point in the (cell, ring) buckets in which it may meet others.

    For a self-join a point visits higher cells.  For a search, ``queries`` is true for
    the side that visits all cells it may reach and false for the side that stays at home.
    """
    slack = eps * 1e-9 + 1e-12                                   # rounding must not lose a pair at the limit

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                part = b.slice(s, 4096)
                D = _distances(matrix(part.column(1)), P)
                home = D.argmin(1)
                own = D[np.arange(len(D)), home]
                near = (D <= R[None] + eps + slack) & (D <= own[:, None] + 2 * eps + slack)
                cells = np.arange(len(P))[None]
                if queries is None:
                    near = (near & (cells > home[:, None])) | (cells == home[:, None])
                elif queries is False:
                    near = cells == home[:, None]
                i, c = np.nonzero(near)
                ring = np.floor(D[i, c] / (eps + slack)).astype(np.int32) if eps > 0 else np.zeros(len(i), np.int32)
                at_home = c == home[i]
                # every row stands in its ring and, as a guest, in the next one; a search sends only the queries there, both ways
                if queries is None:
                    rings = [(ring, False), (ring + 1, True)]
                elif queries:
                    rings = [(ring, False), (ring + 1, True), (ring - 1, True)]
                else:
                    rings = [(ring, False)]
                for r, lower in rings:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int32()), pa.array(r, pa.int32()), pa.array(np.full(len(i), lower)), pa.array(at_home),
                         part.column(0).take(pa.array(i)), part.column(1).take(pa.array(i))], names=["cell", "ring", "lower", "home", "id", "x"])
    return points.where("x IS NOT NULL AND id IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), F.col("x").cast("array<double>").alias("x")).mapInArrow(run, PLACED)


def _with_counts(rows: DataFrame, n: DataFrame) -> DataFrame:
    """``rows`` of the buckets in ``n``; the vectors are not shuffled where the buckets are few."""
    n = materialize(n)
    return rows.join(F.broadcast(n) if n.count() <= HOT_ROWS else n, ["cell", "ring"])


def _tiled(placed: DataFrame) -> DataFrame:
    """Rows with their tile pair: buckets of n rows are cut into ceil(n / TILE) tiles, any two of which meet once."""
    n = placed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("lower"), 1)).alias("residents"))
    n = n.where("residents > 0")                                 # a bucket of guests has no pair
    t = F.ceil(F.col("n") / TILE).cast("int")
    j = _with_counts(placed, n).withColumn("t", t).withColumn("o", F.pmod(F.xxhash64("id", "lower"), F.col("t")).cast("int"))
    return j.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("t") - 1))).select(
        "cell", "ring", F.least("o", "k").alias("ti"), F.greatest("o", "k").alias("tj"), "o", "lower", "home", "id", "x")


Found = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def near_pairs(A: np.ndarray, B: np.ndarray, screen: Callable, exact: Callable, same: bool = False) -> Found:
    """(i, j, value) of rows of A and B in lots: ``screen`` finds candidates by a matrix product
    of a strip of A with B, ``exact`` gives the value of each.  ``same``: B is A, and i < j."""
    for s in range(0, len(A), STRIP):
        at = s if same else 0
        i, j = np.nonzero(screen(A[s:s + STRIP], B[at:]))
        i, j = i + s, j + at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), LOT):
            a, b = i[k:k + LOT], j[k:k + LOT]
            yield a, b, exact(A[a], B[b])


def close_pairs(A: np.ndarray, B: np.ndarray, eps: float, same: bool = False) -> Found:
    """(i, j, distance) of rows of A and B within eps, in lots."""
    def largest(X):
        n = (X * X).sum(1)
        return n[np.isfinite(n)].max(initial=0)
    limit = eps * eps + 1e-9 * (1 + largest(A) + largest(B))

    def screen(P, Q):
        return (P * P).sum(1)[:, None] + (Q * Q).sum(1)[None] - 2 * (P @ Q.T) <= limit
    for i, j, d in near_pairs(A, B, screen, lambda P, Q: np.sqrt(((P - Q) ** 2).sum(1)), same):
        ok = d <= eps
        yield i[ok], j[ok], d[ok]


def distance_join(points: DataFrame, eps: float, n_pivots: int = 16, seed: int = 0) -> DataFrame:
    """Exact epsilon self-join: ``id_a < id_b, l2`` for all pairs with l2 <= eps.

    Rows of one id are no pair; repeated rows give repeated pairs.
    """
    if eps < 0 or math.isnan(eps):
        raise ValueError("eps")
    P = choose_pivots(points, n_pivots, seed)
    schema = "id_a bigint, id_b bigint, l2 double"
    if not len(P):
        return points.sparkSession.createDataFrame([], schema)
    tiles = _tiled(materialize(_placed(points, P, _radii(points, P), eps)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        ids, o = np.asarray(t.column("id").combine_chunks()), np.asarray(t.column("o").combine_chunks())
        lower, home = np.asarray(t.column("lower").to_numpy(zero_copy_only=False)), np.asarray(t.column("home").to_numpy(zero_copy_only=False))
        X = matrix(t.column("x").combine_chunks())
        ti, tj = t.column("ti")[0].as_py(), t.column("tj")[0].as_py()
        roles = [home & ~lower, home & lower, ~home & ~lower, ~home & lower]
        # two residents once, a resident with a guest; of two cells' points one is at home here
        meet = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 2)]
        for m, n in meet if ti == tj else sorted({*meet, *((n, m) for m, n in meet)}):
            a, b = np.flatnonzero(roles[m] & (o == ti)), np.flatnonzero(roles[n] & (o == tj))
            for i, j, d in close_pairs(X[a], X[b], eps, same=ti == tj and m == n):
                i, j = ids[a[i]], ids[b[j]]
                ok = i != j
                i, j = i[ok], j[ok]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(d[ok])], names=["id_a", "id_b", "l2"])
    return tiles.groupBy("cell", "ring", "ti", "tj").applyInArrow(compare, schema)


def join_share(points: DataFrame, eps: float, n_pivots: int = 16, seed: int = 0) -> DataFrame:
    """``points, compared, share``: how many pairs :func:`distance_join` compares, of all pairs."""
    points = points.where("x IS NOT NULL AND id IS NOT NULL")
    P = choose_pivots(points, n_pivots, seed)
    placed = _placed(points, P, _radii(points, P), eps)
    count = lambda c: F.count(F.when(c, 1)).cast("double")
    lower, home = F.col("lower"), F.col("home")
    n = placed.groupBy("cell", "ring").agg(count(~lower & home).alias("rh"), count(~lower & ~home).alias("rv"),
                                            count(lower & home).alias("gh"), count(lower & ~home).alias("gv"))
    pairs = n.agg(F.sum(F.expr("rh * (rh - 1) / 2 + rh * rv + rh * (gh + gv) + rv * gh")).alias("compared"))
    total = points.agg(F.count(F.lit(1)).cast("double").alias("points"))
    # one row each
    return pairs.withColumn("k", F.lit(0)).join(total.withColumn("k", F.lit(0)), "k").select(
        "points", "compared", (F.col("compared") / F.expr("points * (points - 1) / 2")).alias("share"))


def range_neighbors(queries: DataFrame, base: DataFrame, radius: float, n_pivots: int = 16, seed: int = 0) -> DataFrame:
    """L6 exactly: ``qid, id, l2`` of all base points within ``radius`` of each query (so
    none beyond it: the (r, eps) contract for any eps)."""
    schema = "qid bigint, id bigint, l2 double"
    P = choose_pivots(base, n_pivots, seed)
    if not len(P):
        return base.sparkSession.createDataFrame([], schema)
    R = _radii(base, P)
    q = _placed(queries, P, R, radius, True).withColumn("q", F.lit(True))
    rows = materialize(q.unionByName(_placed(base, P, R, radius, False).withColumn("q", F.lit(False))))
    n = rows.groupBy("cell", "ring").agg(F.count(F.when(F.col("q"), 1)).alias("nq"), F.count(F.when(~F.col("q"), 1)).alias("nb")).where("nq > 0 AND nb > 0")
    j = _with_counts(rows, n).withColumn("sq", F.ceil(F.col("nq") / TILE).cast("int")).withColumn("sb", F.ceil(F.col("nb") / TILE).cast("int"))
    mine, other = F.when(F.col("q"), F.col("sq")).otherwise(F.col("sb")), F.when(F.col("q"), F.col("sb")).otherwise(F.col("sq"))
    j = j.withColumn("o", F.pmod(F.xxhash64("id"), mine).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), other - 1)))
    tiles = j.select("cell", "ring", F.when(F.col("q"), F.col("o")).otherwise(F.col("k")).alias("tq"),
                     F.when(F.col("q"), F.col("k")).otherwise(F.col("o")).alias("tb"), "q", "id", "x")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        is_q = t.column("q").to_numpy(zero_copy_only=False)
        ids, X = np.asarray(t.column("id").combine_chunks()), matrix(t.column("x").combine_chunks())
        a, b = np.flatnonzero(is_q), np.flatnonzero(~is_q)
        for i, j, d in close_pairs(X[a], X[b], radius):
            yield pa.RecordBatch.from_arrays([pa.array(ids[a[i]]), pa.array(ids[b[j]]), pa.array(d)], names=["qid", "id", "l2"])
    return tiles.groupBy("cell", "ring", "tq", "tb").applyInArrow(compare, schema)
