import numpy as np
from pyspark.sql import functions as F

from tessera.operators import active as A
from tessera.operators import linear as L
from tessera.operators import vector_lsh as VL


def pool(spark, n=600, d=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    w = rng.normal(size=d)
    y = np.sign(x @ w)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>").repartition(4)
    lab = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "id bigint, y double")
    return x, y, w, df, lab


def test_index_gives_the_hash_candidates(spark):
    x, y, w, df, _ = pool(spark)
    index = A.HyperplaneIndex(df, 6, 5, 9)
    for v in (w, -w, np.eye(6)[0]):
        got = {r.id for r in index.rows.where(index.near(v)).collect()}
        assert got == {r.id for r in VL.hyperplane_lsh_candidates(df, v, 5, 9).collect()}
        # candidates lie nearer to the hyperplane than the others
        cos = np.abs(x @ v) / np.linalg.norm(x, axis=1)
        near = np.isin(np.arange(len(x)), list(got))
        assert cos[near].mean() < cos[~near].mean()


def test_a_round_takes_what_it_says(spark):
    x, y, w, df, lab = pool(spark)
    index = A.HyperplaneIndex(df, 6, 3, 9)
    first = df.where("id < 30").join(lab, "id").select("id", "y", "x")
    w0 = L.pegasos(first, 0.1, 10)
    near = {r.id for r in index.rows.where(index.near(w0)).collect()} - set(range(30))
    rest = sorted(set(range(30, 600)), key=lambda i: (abs(x[i] @ w0), i))

    plain, _, c = A.active_round(index, first, lab, w0, 10, 0.1, 5, 1)
    assert {r.id for r in plain.collect()} == set(range(30)) | set(rest[:10]) and c["asked"] == 10 and c["candidates"] is None
    hashed, _, c = A.active_round(index, first, lab, w0, 10, 0.1, 5, 1, prefilter=True)
    assert {r.id for r in hashed.collect()} - set(range(30)) == set([i for i in rest if i in near][:10]) and c["candidates"] == len(near)
    few, _, _ = A.active_round(index, first, lab, w0, len(near) + 5, 0.1, 5, 1, prefilter=True)
    assert few.count() == 30 + len(near) + 5                         # too few collide: all are scored
    some, _, _ = A.active_round(index, first, lab, w0, 20, 0.1, 5, 1, explore=0.5)
    new = {r.id for r in some.collect()} - set(range(30))
    assert len(new) == 20 and set(rest[:10]) <= new and new != set(rest[:20])
    sub, _, _ = A.active_round(index, first, lab, w0, 10, 0.1, 5, 1, subsample=0.5)
    new = {r.id for r in sub.collect()} - set(range(30))
    assert len(new) == 10 and new != set(rest[:10])
    half = lab.where("id % 2 = 0").unionByName(lab.where("id % 4 = 0"))  # unknown labels, repeated ones
    known, _, c = A.active_round(index, first, half, w0, 10, 0.1, 5, 1)
    assert {r.id for r in known.collect()} == set(range(30)) | {i for i in rest[:10] if i % 2 == 0} and c["asked"] == 10
    a = {r.id for r in A.active_round(index, first, lab, w0, 20, 0.1, 5, 1, 1, explore=1.0)[0].collect()}
    b = {r.id for r in A.active_round(index, first, lab, w0, 20, 0.1, 5, 1, 2, explore=1.0)[0].collect()}
    assert a != b and len(a) == len(b) == 50


def test_an_empty_pool_and_one_that_is_used_up(spark):
    x, y, w, df, lab = pool(spark, n=12)
    first = df.where("id < 10").join(lab, "id").select("id", "y", "x")
    out, _, c = A.active_round(A.HyperplaneIndex(df, 6, 3, 9), first, lab, w, 10, 0.1, 5, 1, prefilter=True, explore=0.3)
    assert out.count() == 12 and c["asked"] == 2
    out, _, c = A.active_round(A.HyperplaneIndex(df.where("false"), 6, 3, 9), first, lab, w, 10, 0.1, 5, 1, prefilter=True)
    assert out.count() == 10 and c["asked"] == 0


def test_ratio_margin(spark):
    x, y, w, df, lab = pool(spark, n=60)
    first = df.where("id < 20").join(lab, "id").select("id", "y", "x")
    cand = df.where("id >= 20")
    lo = {r.id: r.score for r in L.margin_selection(cand, first, 0.1, 5).collect()}
    ratio = {r.id: r.score for r in L.margin_selection(cand, first, 0.1, 5, rule="ratio").collect()}
    assert set(lo) == set(ratio) and all(0 <= v <= 1 for v in ratio.values())
    assert all((ratio[i] > 0) == (lo[i] > 0) for i in lo)
