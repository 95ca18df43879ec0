"""Coresets, seeding and k-means against plain NumPy versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import py_uniform
from tessera.operators import cluster as K
from tessera.operators import partial
from tessera.operators.mahalanobis import mahalanobis, whitening


def cloud(spark, n, d=4, k=6, seed=1, parts=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(k, d))[rng.integers(0, k, n)] * 5 + rng.normal(size=(n, d))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>").repartition(parts)


def cost(x, c):
    return float(((x[:, None] - c[None]) ** 2).sum(2).min(1).mean())


def test_halving_draws_against_numpy(spark):
    x, pts = cloud(spark, 900)
    m, seed = 40, 5
    rest, want, b = np.arange(len(x)), {}, 0
    while True:
        keys = sorted((-math.log(py_uniform(seed + b, "uni", int(i))), int(i)) for i in rest)
        draw = sorted(int(i) for i in rest) if len(rest) <= m else sorted(i for _, i in keys[:m])
        want |= {i: b for i in draw}
        if len(rest) <= m:
            break
        d2 = ((x[rest][:, None] - x[draw][None]) ** 2).sum(2).min(1)
        order = np.lexsort((rest, d2))
        rest = rest[order[len(rest) // 2:]]
        b += 1
    assert b == 5
    for p in (pts, pts.repartition(7)):
        assert {r.id: r.b for r in K.halving_draws(p, m, seed).collect()} == want


def test_halving_coreset_weights_and_cost(spark):
    x, pts = cloud(spark, 1500)
    kw = {"k": 3, "eps": 0.5, "seed": 9, "m": 60, "n_draw": 400}
    rows = K.halving_coreset(pts, **kw).collect()
    again = K.halving_coreset(pts.repartition(9), **kw).collect()
    key = lambda rs: sorted((r.id, r.b, r.cid, r.times, round(r.weight, 6)) for r in rs)
    assert key(rows) == key(again) and len({r.b for r in rows}) >= 4
    assert 0.8 * len(x) < sum(r.weight for r in rows) < 1.2 * len(x)
    assert abs(sum(r.times for r in rows) - 400) < 80
    # q is the specified one
    B = sorted(r.id for r in K.halving_draws(pts, 60, 9).collect())
    d2 = ((x[:, None] - x[B][None]) ** 2).sum(2)
    cell, near = d2.argmin(1), d2.min(1)
    q = 5 / np.bincount(cell, minlength=len(B))[cell] + near / near.sum()
    q /= q.sum()
    for r in rows:
        assert r.cid == cell[r.id] and abs(r.q - q[r.id]) < 1e-9 and abs(r.weight - r.times / (400 * q[r.id])) < 1e-6
    c = x[np.random.default_rng(3).integers(0, len(x), 5)]
    est = sum(r.weight * min(((np.array(r.x) - v) ** 2).sum() for v in c) for r in rows) / len(x)
    assert 0.8 < est / cost(x, c) < 1.25
    assert K.halving_coreset(pts.where("false"), **kw).count() == 0
    assert K.halving_coreset(pts.where("id < 30"), **kw).count() > 0      # fewer points than one draw


def test_poisson_times_have_the_right_mean(spark):
    df = spark.range(4000).select("id", F.expr("CASE id % 4 WHEN 0 THEN 0.01D WHEN 1 THEN 1.0D WHEN 2 THEN 30.0D ELSE 900.0D END").alias("l"))
    got = df.select("l", K.poisson_times(F.col("l"), 1, "t", "id").alias("k")).groupBy("l").agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).collect()
    for r in got:
        assert abs(r.m - r.l) < 5 * math.sqrt(r.l / 1000) + 1e-9 and (r.l < 1 or 0.7 * r.l < r.v < 1.35 * r.l)


def test_kmeans_parallel_is_as_good_as_sequential_seeding(spark):
    for d, k in ((4, 20), (8, 40)):
        x, pts = cloud(spark, 3000, d=d, k=k, seed=d)
        pp = K.drawn_centers(K.kmeans_pp(pts, k, 3).select("id", "x"))[1]
        par = K.kmeans_parallel(pts, k, 3)
        assert par.count() == k
        assert cost(x, K.drawn_centers(par.select("id", "x"))[1]) <= 1.2 * cost(x, pp)
    a = K.kmeans_parallel(pts, 10, 4).collect()
    assert a == K.kmeans_parallel(pts.repartition(9), 10, 4).collect()
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id bigint, x array<double>")
    assert K.kmeans_parallel(same, 5, 1).count() == 1
    assert K.kmeans_parallel(same.where("false"), 5, 1).count() == 0


def test_compress_of_unit_weights_is_a_plain_coreset(spark):
    _, pts = cloud(spark, 400)
    cen = K.drawn_centers(pts.where("id < 8"))
    a = {r.id: round(r.weight, 9) for r in K.coreset(pts, cen, 60, 4).collect()}
    b = {r.id: round(r.weight, 9) for r in K.coreset_compress(pts.withColumn("weight", F.lit(1.0)), cen, 60, 4).collect()}
    assert a == b
    # a point of weight w counts as w points in the sensitivities
    twice = pts.withColumn("w", F.when(F.col("id") < 100, 3.0).otherwise(1.0))
    copies = pts.unionByName(pts.where("id < 100")).unionByName(pts.where("id < 100"))
    q1 = {r.id: r.q for r in K.coreset_probs(twice, cen, weight="w").collect()}
    q2 = {r.id: r.q for r in K.coreset_probs(copies, cen).groupBy("id").agg(F.sum("q").alias("q")).collect()}
    assert all(abs(q1[i] - q2[i]) < 1e-12 for i in q2)


def test_compat_k_means_is_the_reference_loop(spark):
    x, pts = cloud(spark, 300)
    rng = np.random.default_rng(4)
    w = rng.uniform(0.2, 5, len(x))
    df = pts.join(spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "id bigint, w double"), "id")
    C = x[:5].copy()
    want, old, rounds = C.copy(), np.zeros_like(C), 0
    for _ in range(30):
        if np.linalg.norm(want - old) < 0.5:
            break
        near = ((x[:, None] - want[None]) ** 2).sum(2).argmin(1)
        old = want.copy()
        want = np.array([x[near == i].mean(0) if (near == i).any() else want[i] for i in range(5)])
        rounds += 1
    (_, got), r = K.kmeans_lloyd(df, (np.arange(5, dtype=np.int32), C), 30, 0.5, weight="w", compat=True)
    assert r == rounds > 1 and np.allclose(got, want)
    # seeding: uniform first centre, weights only in the distances to it
    ids, md = [min(range(len(x)), key=lambda i: (-math.log(py_uniform(6, "kpp:0", i)), i))], None
    for r in range(1, 6):
        d = ((x - x[ids[-1]]) ** 2).sum(1) * (w if r == 1 else 1)
        md = d if md is None else np.minimum(md, d)
        ids.append(min((i for i in range(len(x)) if md[i] > 0), key=lambda i: (-math.log(py_uniform(6, f"kpp:{r}", i)) / md[i], i)))
    assert [r.id for r in K.kmeans_pp(df, 6, 6, weight="w", compat=True).orderBy("cid").collect()] == ids


def test_sums_do_not_depend_on_lots_and_skip_nulls(spark, monkeypatch):
    rows = [(i % 3, [float(i), 1.0], float(i % 5)) for i in range(500)] + [(None, [1.0, 1.0], 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, x array<double>, w double").repartition(13)
    want = {k: np.average([r[1] for r in rows[:500] if r[0] == k], axis=0, weights=[r[2] for r in rows[:500] if r[0] == k]) for k in range(3)}
    for lots in (1, 3, 64):
        monkeypatch.setattr(partial, "LOTS", lots)
        got = partial.mean_by_key(df, "k", weight="w")
        assert [k for k, _, _ in got] == [0, 1, 2] and all(np.allclose(m, want[k]) for k, _, m in got)
    assert partial.mean_by_key(df.where("false"), "k") == []


def test_whitening_is_the_mahalanobis_distance(spark):
    x, pts = cloud(spark, 500, d=5)
    x = x + 1e6                                                  # a large offset costs no digits
    far = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>").repartition(5)
    mean, G = whitening(far)
    inv = np.linalg.inv(np.cov(x.T, bias=True))
    got = {r.id: r.norm for r in mahalanobis(far.unionByName(spark.createDataFrame([(900, None)], "id bigint, x array<double>")), G, center=mean).collect()}
    dev = x - x.mean(0)
    assert np.allclose([got[i] for i in range(len(x))], np.sqrt(np.einsum("ij,jk,ik->i", dev, inv, dev)), rtol=1e-6) and got[900] is None
    with pytest.raises(np.linalg.LinAlgError):
        whitening(pts.where("id < 3"))
    assert whitening(pts.where("id < 3"), ridge=0.1)[1].shape == (5, 5)


def test_nearest_centres_hold_few_differences_at_once():
    import tracemalloc
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(300, 64)), rng.normal(size=(1500, 64))
    tracemalloc.start()
    try:
        cid, d2 = K._nearest(x, np.arange(len(c), dtype=np.int32), c)
        assert tracemalloc.get_traced_memory()[1] < 12 << 20
    finally:
        tracemalloc.stop()
    want = np.array([((v - c) ** 2).sum(1) for v in x])
    assert (cid == want.argmin(1)).all() and np.allclose(d2, want.min(1))
