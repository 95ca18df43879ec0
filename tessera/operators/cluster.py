"""Clustering: nearest centre, k-means++ / Lloyd, coresets.

Points are ``id, x array<double>`` (plus an optional weight column).  Centres
are a model-sized table ``cid, x``: they are brought to the driver after a
size check (k*d bounded by ``MAX_CENTER_CELLS``) and shipped to tasks inside
an Arrow-batched function, which computes the distance block of a batch with
NumPy.  Points never reach the driver; each Lloyd round is one distributed
assign + aggregate returning k*d numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import vectors as V
from tessera.functions.hashing import py_uniform, uniform
from tessera.operators.partial import collect_sums, grouped, matrix, mean_by_key, means_of, weighted_rows
from tessera.operators.sampling import race_key, uniform_sample, up_to, weighted_sample
from tessera.session import cut_lineage, swap

MAX_CENTER_CELLS = 20_000_000  # k * d doubles (160 MB) allowed on the driver / in a task

NEAREST_CELLS = 1 << 18    # differences (2 MB) that a task holds at once; they fit the processor's cache

ASSIGN_TYPE = T.StructType([T.StructField("cid", T.IntegerType()), T.StructField("d2", T.DoubleType())])


# ------------------------------------------------------------------ centres
def centers_to_numpy(centers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Collect a centre table (``cid, x``) after checking its size."""
    k = centers.count()
    first = centers.select(F.size("x")).first()
    d = first[0] if first else 0
    if k * max(d, 1) > MAX_CENTER_CELLS:
        raise ValueError(f"{k} centres x {d} dims exceed the model size bound")
    rows = centers.select("cid", "x").orderBy("cid").collect()
    cids = np.array([r["cid"] for r in rows], dtype=np.int32)
    C = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), d)
    return cids, C


def drawn_centers(drawn: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centres 0..m-1 from drawn points ``id, x``, numbered by id (size-checked)."""
    m, first = drawn.count(), drawn.select(F.size("x")).first()
    d = first[0] if first else 0
    if m * max(d, 1) > MAX_CENTER_CELLS:
        raise ValueError(f"{m} drawn points x {d} dims exceed the model size bound")
    rows = sorted(drawn.select("id", "x").collect(), key=lambda r: r["id"])
    return np.arange(len(rows), dtype=np.int32), np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), d)


def _nearest(X: np.ndarray, cids: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest cid, lowest on ties; squared distance) of the rows of X, in blocks."""
    n = len(X)
    cid, d2 = np.zeros(n, dtype=np.int32), np.zeros(n)
    block = max(1, NEAREST_CELLS // max(1, C.shape[0] * C.shape[1]))
    for s in range(0, n if len(C) else 0, block):
        diff = X[s:s + block, None, :] - C[None, :, :]
        D = np.einsum("ijk,ijk->ij", diff, diff)
        j = np.argmin(D, axis=1)  # first minimum = lowest cid (centres sorted)
        cid[s:s + block], d2[s:s + block] = cids[j], D[np.arange(len(j)), j]
    return cid, d2


def _nearest_udf(cids: np.ndarray, C: np.ndarray):
    @F.pandas_udf(ASSIGN_TYPE)
    def _near(xs: pd.Series) -> pd.DataFrame:
        X = np.stack(xs.to_numpy()).astype(np.float64) if len(xs) else np.zeros((0, C.shape[1]))
        cid, d2 = _nearest(X, cids, C)
        return pd.DataFrame({"cid": cid, "d2": d2})

    return _near


def nearest_center(points: DataFrame, centers: DataFrame | tuple, x_col: str = "x") -> DataFrame:
    """Add ``cid`` (nearest centre, lowest cid on ties) and ``d2``."""
    cids, C = centers if isinstance(centers, tuple) else centers_to_numpy(centers)
    a = _nearest_udf(cids, C)(F.col(x_col))
    return points.withColumn("_a", a).select("*", F.col("_a.cid").alias("cid"),
                                             F.col("_a.d2").alias("d2")).drop("_a")


# ------------------------------------------------------------------ stats
def cell_stats(assigned: DataFrame, weight: str | None = None) -> DataFrame:
    """Per cell ``cid, n_cell, sum_d2`` (map-side partial aggregation); with weights
    their sum and the weighted sum of distances."""
    if weight:
        return assigned.groupBy("cid").agg(F.sum(weight).alias("n_cell"), F.sum(F.col("d2") * F.col(weight)).alias("sum_d2"))
    return assigned.groupBy("cid").agg(F.count(F.lit(1)).alias("n_cell"), F.sum("d2").alias("sum_d2"))


def with_cell_stats(assigned: DataFrame) -> DataFrame:
    """C4: per-cell count and distance sum joined back to each point.

    The cell table has one row per centre (k rows, bounded by the model
    size check), so it is broadcast.
    """
    return assigned.join(F.broadcast(cell_stats(assigned)), "cid")


def kmeans_cost(points: DataFrame, centers, weight: str | None = None, mean: bool = True) -> DataFrame:
    """Mean (or weighted sum) over points of the min squared distance."""
    a = nearest_center(points, centers)
    if weight:
        return a.agg(F.sum(F.col("d2") * F.col(weight)).alias("cost"))
    return a.agg((F.avg("d2") if mean else F.sum("d2")).alias("cost"))


# ------------------------------------------------------------------ coreset
def coreset_probs(points: DataFrame, centers, k: int | None = None, weight: str | None = None) -> DataFrame:
    """K3: importance-sampling probability of every point.

    s(x) = a d(x)/c + 2a sum_cell d/(n_cell c) + 4 n/n_cell with
    a = 16 (log2 k + 2), c = mean min distance; q = s / sum s.  When c = 0
    (every point on a centre) only the 4n/n_cell term is kept.

    A weighted point stands for ``weight`` points: n, the cells' sizes and all sums
    of distances count it so often, and q is proportional to weight * s.
    """
    cids, C = centers if isinstance(centers, tuple) else centers_to_numpy(centers)
    k = k or len(cids)
    alpha = 16.0 * (math.log2(k) + 2.0)
    one = F.col(weight) if weight else F.lit(1.0)
    a = nearest_center(points, (cids, C))
    cells = cell_stats(a, weight).persist(StorageLevel.MEMORY_AND_DISK)  # one row for each centre
    tot = cells.agg(F.sum("n_cell").alias("n"), F.sum("sum_d2").alias("s")).first()
    n, sd = float(tot["n"] or 0), float(tot["s"] or 0.0)
    cphi = sd / n if n else 0.0
    far = F.lit(alpha) * F.col("d2") / F.lit(cphi) if cphi > 0 else F.lit(0.0)
    near = F.lit(4.0 * n) / F.col("n_cell")
    if cphi > 0:
        near = F.lit(2 * alpha) * F.col("sum_d2") / (F.col("n_cell") * F.lit(cphi)) + near
    # the sum of s over a cell is made of the cell's own sums
    total = cells.agg(F.sum((F.lit(alpha / cphi) * F.col("sum_d2") if cphi > 0 else F.lit(0.0)) + near * F.col("n_cell"))).first()[0]
    return a.join(F.broadcast(cells), "cid").withColumn("q", one * (far + near) / F.lit(total))


def _drawn(rows: DataFrame, p: str, n: int, seed: int, tag: str, compat: bool = False) -> DataFrame:
    """A weighted sample whose distances are computed once; only the drawn rows are kept."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cut_lineage(weighted_sample(rows, p, n, seed, "id", compat=compat, tag=tag))
    finally:
        rows.unpersist()


def coreset(points: DataFrame, centers, n: int, seed: int, compat: bool = False) -> DataFrame:
    """K2: coreset of n weighted points drawn by q (weights estimate counts)."""
    return _drawn(coreset_probs(points, centers), "q", n, seed, "coreset", compat)


def coreset_compress(cs: DataFrame, centers, n: int, seed: int, weight: str = "weight") -> DataFrame:
    """A coreset of n points of a weighted coreset ``id, x, weight``.

    Points are drawn by the weighted sensitivities; a drawn point's weight is its old
    one times the inverse of its chance, so sums of weights stay unbiased.  With
    weights of 1 this is K2.
    """
    q = coreset_probs(cs.withColumn("_w0", F.col(weight).cast("double")).drop(weight), centers, weight="_w0")
    s = _drawn(q, "q", n, seed, "coreset")
    return s.withColumn("weight", F.col("_w0") * F.col("weight")).drop("_w0")


def d2_sample(points: DataFrame, centers, n: int, seed: int, compat: bool = False) -> DataFrame:
    """K1: n points drawn with probability proportional to min squared distance."""
    return _drawn(nearest_center(points, centers), "d2", n, seed, "d2", compat)


# ------------------------------------------------------------------ k-means++
def kmeans_pp(points: DataFrame, k: int, seed: int, weight: str | None = None,
              checkpoint_every: int = 8, compat: bool = False) -> DataFrame:
    """K4: sequential D^2 seeding, k rounds -> ``cid, id, x``.

    Round 0 draws a point with probability proportional to its weight,
    round r with probability proportional to weight * (min squared distance
    to the chosen centres), each by an md5 exponential race (argmin of
    -ln(u)/p, id tie-break).  A running min-distance column is updated per
    round (one pass, one 1-row TakeOrdered); lineage is cut by a reliable
    checkpoint every few rounds.  Points at distance 0 are never redrawn.

    ``compat`` draws as the reference does: the weights only scale the distances to
    the first centre, which is drawn uniformly.  For large k see :func:`kmeans_parallel`.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    cur = points.select("id", "x", w.cast("double").alias("_w"))
    chosen = []
    md = None
    for r in range(k):
        if r == 0:
            p = F.lit(1.0) if compat else F.col("_w")
        else:
            p = F.col("_md") if compat else F.col("_w") * F.col("_md")
        cand = cur.where(p > 0).withColumn("_key", race_key("id", p, seed, f"kpp:{r}"))
        best = cand.orderBy("_key", "id").limit(1).select("id", "x").collect()
        if not best:
            break
        cid, x = best[0]["id"], best[0]["x"]
        chosen.append((r, cid, [float(v) for v in x]))
        d = V.sqdist(F.col("x"), x)
        if compat and r == 0:
            d = d * F.col("_w")
        md = d if r == 0 else F.least(F.col("_md"), d)
        nxt = cur.withColumn("_md", md).select("id", "x", "_w", "_md")
        cur = swap(cur if r > 0 else None, nxt, checkpoint=(r + 1) % checkpoint_every == 0)
    spark = points.sparkSession
    return spark.createDataFrame(chosen, "cid int, id bigint, x array<double>")


def kmeans_parallel(points: DataFrame, k: int, seed: int, oversample: float = 2.0, rounds: int = 5,
                    weight: str | None = None) -> DataFrame:
    """K4 for large k (k-means||) -> ``cid, id, x``: as many passes as rounds, not as centres.

    Each round takes every point independently with probability ``oversample`` k
    times its share of the weighted squared distance to the candidates so far (an
    md5 uniform of seed, round and id decides), so about ``oversample`` k candidates
    come in a pass.  One more pass weighs each candidate by the points nearest to it;
    the weighted candidates, a model-sized set, are reduced to k by D^2 seeding.
    Rounds end early when every point lies on a candidate.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cur = points.select("id", "x", w.alias("_w")).where("_w > 0")
    first = cur.withColumn("_key", race_key("id", F.col("_w"), seed, "kpar:first")).orderBy("_key", "id").limit(1).select("id", "x").collect()
    if not first:
        return points.sparkSession.createDataFrame([], "cid int, id bigint, x array<double>")
    found = {first[0]["id"]: first[0]["x"]}
    fresh, held = found, None
    for r in range(rounds):
        _, C = np.arange(len(fresh)), np.array([fresh[i] for i in sorted(fresh)], dtype=np.float64)
        near = nearest_center(cur, (np.arange(len(C), dtype=np.int32), C)).withColumn(
            "_md", F.least(F.col("_md"), F.col("d2")) if held is not None else F.col("d2"))
        nxt = near.select("id", "x", "_w", "_md").persist(StorageLevel.MEMORY_AND_DISK)
        phi = nxt.agg(F.sum(F.col("_w") * F.col("_md"))).first()[0] or 0.0
        if held is not None:
            held.unpersist()
        cur = held = nxt
        if phi <= 0:
            break
        chance = F.lit(oversample * k / phi) * F.col("_w") * F.col("_md")
        drawn = cur.where(uniform(seed, f"kpar:{r}", F.col("id")) < chance).select("id", "x")
        if (len(found) + drawn.count()) * C.shape[1] > MAX_CENTER_CELLS:
            raise ValueError("candidates exceed the model size bound")
        fresh = {row["id"]: row["x"] for row in drawn.collect() if row["id"] not in found}
        found |= fresh
        if not fresh:
            continue
    ids = sorted(found)
    C = np.array([found[i] for i in ids], dtype=np.float64)
    mass = {key: n for key, n, _ in mean_by_key(nearest_center(cur, (np.arange(len(C), dtype=np.int32), C)), "cid", weight="_w", cells=C.size)}
    if held is not None:
        held.unpersist()
    chosen = _seed_weighted(C, np.array([mass.get(i, 0.0) for i in range(len(C))]), k, seed)
    return points.sparkSession.createDataFrame([(r, int(ids[i]), [float(v) for v in C[i]]) for r, i in enumerate(chosen)], "cid int, id bigint, x array<double>")


def _seed_weighted(C: np.ndarray, mass: np.ndarray, k: int, seed: int, tries: int = 8) -> list[int]:
    """D^2 seeding among weighted candidates: of ``tries`` draws a round the one that lowers the cost most."""
    md, out = None, []
    for r in range(min(k, int((mass > 0).sum()))):
        p = mass if md is None else mass * md
        if p.sum() <= 0:
            break
        at = np.unique(np.searchsorted(np.cumsum(p), np.array([py_uniform(seed, f"kpar:pick:{r}", t) for t in range(tries)]) * p.sum()).clip(0, len(C) - 1))
        d = ((C[at][:, None, :] - C[None]) ** 2).sum(2)
        new = d if md is None else np.minimum(md, d)
        best = int(np.argmin(new @ mass))
        out.append(int(at[best]))
        md = new[best]
    return out


# ------------------------------------------------------------------ Lloyd
def kmeans_update(assigned: DataFrame, old: tuple, weight: str | None = None) -> tuple:
    """(weighted) mean of the points of each cell; an empty cell keeps its centre."""
    return _moved(old, mean_by_key(assigned, "cid", weight=weight, cells=old[1].size))


def _moved(old: tuple, means: list) -> tuple:
    cids, C = old
    newC = C.copy()
    idx = {int(c): i for i, c in enumerate(cids)}
    for cid, _, mean in means:
        newC[idx[cid]] = mean
    return cids, newC


def _lloyd_round(points: DataFrame, centers: tuple, weight: str | None) -> tuple:
    """Distances and sums of one round in one pass: a task sends its k x d sums."""
    cids, C = centers

    def part(b):
        X = matrix(b.column(0))
        cid, _ = _nearest(X, cids, C)
        return grouped(cid.astype(np.int64), weighted_rows(X, np.asarray(b.column(1))))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return _moved(centers, means_of(collect_sums(points.select("x", w.alias("w")), part, C.size)))


def kmeans_lloyd(points: DataFrame, centers, max_iter: int = 50, tol: float = 0.0,
                 weight: str | None = None, compat: bool = False) -> tuple[tuple, int]:
    """K5: Lloyd iterations; stop when ||C_new - C||_F < tol or after max_iter.

    Returns ((cids, centres), rounds run).  ``weight`` gives a truly weighted mean
    (coresets).  A round adds k x d numbers a task.  ``compat`` runs as the reference
    does: weights change nothing, and the last change (at first the distance from
    the origin) is tested before a round, not after it.
    """
    cids, C = centers if isinstance(centers, tuple) else centers_to_numpy(centers)
    pts = points.persist(StorageLevel.MEMORY_AND_DISK)
    rounds, before = 0, np.zeros_like(C)
    try:
        while rounds < max_iter:
            if compat and float(np.linalg.norm(C - before)) < tol:
                break
            before = C
            cids, C = _lloyd_round(pts, (cids, C), None if compat else weight)
            rounds += 1
            if not compat and float(np.linalg.norm(C - before)) < tol:
                break
    finally:
        pts.unpersist()
    return (cids, C), rounds


def centers_long(spark, centers: tuple) -> DataFrame:
    cids, C = centers
    rows = [(int(c), int(j), float(v)) for c, row in zip(cids, C) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "cid int, j int, v double")


def coreset_kmeans(points: DataFrame, k: int, n_seed: int, n_sample: int, seed: int,
                   tol_core: float = 0.09, tol_full: float = 0.5, max_iter: int = 50, compat: bool = False) -> tuple:
    """K6: coreset from uniform seed centres over the full data, k-means++ and
    Lloyd on the weighted coreset, then Lloyd on all points from there.  ``compat``
    uses the reference's weights, draws and stop test."""
    cs = coreset(points, drawn_centers(uniform_sample(points, n_seed, seed, "id")), n_sample, seed + 1, compat)
    cs = cs.select("id", "x", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    init = kmeans_pp(cs, k, seed + 2, weight="weight", compat=compat)
    cen, _ = kmeans_lloyd(cs, init.select("cid", "x"), max_iter, tol_core, weight="weight", compat=compat)
    final, rounds = kmeans_lloyd(points, cen, max_iter, tol_full, compat=compat)
    cs.unpersist()
    return final, rounds


# ------------------------------------------------------------------ halving coreset
def halving_draws(points: DataFrame, m: int, seed: int) -> DataFrame:
    """The union B of the draws, ``id, x, b``: of what is left m points are drawn and the
    nearer half to them goes, until no more than m are left, which all join B.

    The half is cut at the exact middle of (distance, id), found by histograms; both
    halves stay distributed.
    """
    rest, drawn, b = points.select("id", "x"), None, 0
    while True:
        n = rest.count()
        s = rest if n <= m else uniform_sample(rest, m, seed + b, "id").select("id", "x")
        s = cut_lineage(s.withColumn("b", F.lit(b)))
        drawn = s if drawn is None else drawn.unionByName(s)
        if n <= m:
            return drawn
        a = nearest_center(rest, drawn_centers(s)).select("id", "x", "d2").persist(StorageLevel.MEMORY_AND_DISK)
        rest = cut_lineage(a.where(~up_to(a, "d2", "id", n // 2)).select("id", "x"))
        a.unpersist()
        b += 1


def poisson_times(lam, seed: int, tag: str, id_col: str):
    """How often a row is drawn if it is drawn ``lam`` times on average (Poisson, from md5
    uniforms of seed, tag and id).  Large means are split into parts of at most 256."""
    @F.pandas_udf(T.LongType())
    def _times(lams: pd.Series, ids: pd.Series) -> pd.Series:
        lam, out = lams.to_numpy(dtype=np.float64), np.zeros(len(lams), np.int64)
        parts = np.maximum(np.ceil(lam / 256), 1).astype(np.int64)
        for j in range(int(parts.max()) if len(lam) else 0):
            at = np.flatnonzero(parts > j)
            one = lam[at] / parts[at]
            u = np.array([py_uniform(seed, f"{tag}:{j}", i) for i in ids.iloc[at]])
            p, k = np.exp(-one), 0
            below, todo = p.copy(), np.arange(len(at))
            while len(todo):
                more = u[todo] > below[todo]
                todo = todo[more]
                k += 1
                out[at[todo]] += 1
                p[todo] *= one[todo] / k
                below[todo] += p[todo]
                todo = todo[(p[todo] > 1e-18) | (k < one[todo])]
        return pd.Series(out)
    return _times(lam, F.col(id_col))


def halving_coreset(points: DataFrame, k: int, eps: float, seed: int, delta: float = 0.1,
                    m: int | None = None, n_draw: int | None = None) -> DataFrame:
    """K9: ``id, x, b, cid, d2, q, times, weight`` of a coreset drawn from all points.

    B is the union of :func:`halving_draws` of m = 10 d k log(1/eps) points each.  One
    pass puts every point into the cell D_b of its nearest point of B; then
    q ~ 5/|D_b| + d^2 / sum d^2, and |C| = 10 d k log^2(n) log(1/delta) / eps^2 draws by q
    are made with replacement: each point comes Poisson(|C| q) times, of weight
    1/(|C| q) each time, so the sum of weights estimates n.  ``b`` is the draw to which
    the cell's centre belongs.
    """
    n = points.count()
    first = points.select("x").first()
    d = len(first["x"]) if first else 0
    if not n:
        return points.sparkSession.createDataFrame([], "id bigint, x array<double>, b int, cid int, d2 double, q double, times bigint, weight double")
    m = m or max(1, math.ceil(10 * d * k * math.log(1.0 / eps)))
    B = halving_draws(points, m, seed)
    cids, C = drawn_centers(B)
    a = nearest_center(points.select("id", "x"), (cids, C))
    cells = cell_stats(a).persist(StorageLevel.MEMORY_AND_DISK)
    s, occupied = cells.agg(F.sum("sum_d2"), F.count(F.lit(1))).first()
    # every cell's 5/|D_b| adds up to 5, all distances to 1
    total = 5.0 * occupied + (1.0 if s > 0 else 0.0)
    q = (F.lit(5.0) / F.col("n_cell") + (F.col("d2") / F.lit(s) if s > 0 else F.lit(0.0))) / F.lit(total)
    size = n_draw or max(1, math.ceil(10 * d * k * math.log(max(n, 2)) ** 2 * math.log(1.0 / delta) / eps ** 2))
    layer = points.sparkSession.createDataFrame(
        [(i, int(r["b"])) for i, r in enumerate(sorted(B.select("id", "b").collect(), key=lambda r: r["id"]))], "cid int, b int")
    drawn = a.join(F.broadcast(cells), "cid").withColumn("q", q).withColumn("times", poisson_times(F.lit(float(size)) * q, seed, "halving", "id")).where("times > 0")
    return (drawn.join(F.broadcast(layer), "cid").withColumn("weight", F.col("times") / (F.lit(float(size)) * F.col("q")))
            .select("id", "x", "b", "cid", "d2", "q", "times", "weight"))
