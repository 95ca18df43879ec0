"""A model kept as a table of blocks gives what the model in the closure gives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import linear as L
from tessera.operators import wide_linear as W


def rows(spark, n, d, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) / np.sqrt(d)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=n) / np.sqrt(d) > 0, 1.0, -1.0)
    return x, y, spark.createDataFrame([(i, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))], "id bigint, y double, x array<double>").repartition(4)


def dense(model, D):
    out = np.zeros(D)
    for r in model.collect():
        out[r["block"] * L.BLOCK:r["block"] * L.BLOCK + len(r["w"])] = r["w"]
    return out


def test_width_160000_by_blocks(spark, monkeypatch):
    """400 numbers, degree-2 features: the reference's width, with a limit of a few blocks."""
    monkeypatch.setattr(L, "BLOCK", 20_000)
    x, y, df = rows(spark, 60, 400)
    D = L.feature_width(400, "poly2")
    assert D == 160_000
    want, n = L.vector_sum(df, "poly2", coef="y")
    assert n == 60
    model = W.vector_sum(df, D, "poly2", "y", limit=50_000)
    assert np.allclose(dense(model, D), want, atol=1e-12) and model.count() == 8
    got = {r.id: r.score for r in W.score(df, model, D, "poly2").collect()}
    exp = {r.id: r.score for r in L.svm_score(df, want, "poly2").collect()}
    assert all(abs(got[i] - exp[i]) < 1e-9 for i in range(60))
    with pytest.raises(ValueError):
        monkeypatch.setattr(L, "MAX_MODEL", 100_000)
        L.vector_sum(df, "poly2")


@pytest.mark.parametrize("features,d", [("raw", 37), ("poly2", 9)])
def test_pegasos_by_blocks(spark, monkeypatch, features, d):
    monkeypatch.setattr(L, "BLOCK", 10)
    x, y, df = rows(spark, 200, d, 3)
    D = L.feature_width(d, features)
    want = L.pegasos(df, 0.05, 4, features)
    got = W.pegasos(df, 0.05, 4, features, limit=25)
    assert np.allclose(dense(got, D), want, atol=1e-10) and abs(W.norm(got) - np.linalg.norm(want)) < 1e-9
    assert np.allclose(L.model_vector(W.long_form(got), D), want, atol=1e-10)


def test_batches_of_pegasos_are_its_own_files(spark):
    x, y, df = rows(spark, 300, 5, 4)
    w = L.pegasos(df, 0.1, 6, batch_size=100, seed=2)
    nb, e = 3, np.zeros(5)
    b = {r.id: r.batch for r in L.hash_batches(df, nb, 2).collect()}
    for t in range(1, 7):
        at = np.array([b[i] == (t - 1) % nb for i in range(300)])
        v = at & (y * (x @ e) < 1)
        eta = 1 / (0.1 * t)
        e = (1 - eta * 0.1) * e + eta / at.sum() * (y[v] @ x[v])
        e *= min(1.0, 1 / np.sqrt(0.1) / np.linalg.norm(e))
    assert np.allclose(w, e)
    assert (L.pegasos(df.where("false"), 0.1, 2) == 0).all()


def test_averaged_models_and_kernels(spark, monkeypatch):
    x, y, df = rows(spark, 240, 6, 5)
    whole = L.model_vector(L.parallel_svm(df, 60, 7, "poly2"), 36)
    monkeypatch.setattr(L, "BLOCK", 7)
    assert np.allclose(L.model_vector(L.parallel_svm(df.repartition(3), 60, 7, "poly2"), 36), whole)
    sv, coef = x[:50], y[:50]
    got = {r.id: r.kscore for r in L.rbf_kernel_scores(df, sv, coef, 0.7).collect()}
    k = np.exp(-0.7 * ((x[:, None] - sv[None]) ** 2).sum(2)) @ coef
    assert np.allclose([got[i] for i in range(240)], k)
    assert L.vector_sum(df.where(F.lit(False)))[1] == 0
