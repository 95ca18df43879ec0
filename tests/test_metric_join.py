"""Pivot joins are exact, and prune wherever the data have clusters."""

import numpy as np
import pytest

from tessera.operators import metric_join as M
from tessera.operators import vector_lsh as VL


def cloud(spark, x, ids=None, parts=3):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "id bigint, x array<double>").repartition(parts)


def brute(x, eps):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    return {(i, j) for i, j in zip(*np.nonzero(np.triu(d <= eps, 1)))}


def clustered(n, d, k, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(k, d))[rng.integers(0, k, n)] * 4 + rng.normal(size=(n, d)) * spread


@pytest.mark.parametrize("n,d,k,eps,pivots", [(400, 8, 8, 1.0, 16), (300, 3, 4, 0.2, 4), (200, 16, 1, 1.5, 8), (250, 5, 5, 100.0, 6), (150, 2, 3, 0.0, 5)])
def test_self_join_is_exact(spark, monkeypatch, n, d, k, eps, pivots):
    x = clustered(n, d, k, n)
    x[:10] = x[10:20]                                     # equal vectors
    x = np.round(x, 1) if eps == 0.2 else x               # many pairs at the limit
    df = cloud(spark, x)
    for tile in (M.TILE, 17):
        monkeypatch.setattr(M, "TILE", tile)
        rows = M.distance_join(df, eps, pivots, 3).collect()
        got = [(r.id_a, r.id_b) for r in rows]
        assert len(got) == len(set(got)) and set(got) == brute(x, eps)
        assert all(abs(r.l2 - np.linalg.norm(x[r.id_a] - x[r.id_b])) < 1e-9 for r in rows)


def test_clusters_are_pruned(spark):
    x = clustered(2000, 32, 12, 5)
    r = M.join_share(cloud(spark, x), 1.0).first()
    print(f"compared {r.share:.3f} of {r.points:.0f} points' pairs")
    assert r.share < 0.5
    assert r.share < 0.2                                  # twelve clusters: a twelfth, and little more


def test_range_search_is_exact(spark, monkeypatch):
    x, q = clustered(500, 6, 6, 2), clustered(60, 6, 6, 3)
    q = np.concatenate([q, x[:5]])
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    for radius, tile in ((1.0, 2048), (1.0, 13), (5.0, 50), (0.0, 2048)):
        monkeypatch.setattr(M, "TILE", tile)
        rows = M.range_neighbors(cloud(spark, q), cloud(spark, x), radius, 7, 1).collect()
        got = [(r.qid, r.id) for r in rows]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for i, j in zip(*np.nonzero(d <= radius))}


def test_empty_nulls_and_repeats(spark):
    none = cloud(spark, np.zeros((3, 2))).where("false")
    assert M.distance_join(none, 1.0).collect() == [] and M.range_neighbors(none, none, 1.0).collect() == []
    df = spark.createDataFrame([(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.5]), (3, None), (None, [9.0, 9.0])], "id bigint, x array<double>")
    assert [(r.id_a, r.id_b) for r in M.distance_join(df, 1.0).collect()] == [(1, 2), (1, 2)]
    assert M.range_neighbors(df.where("id = 2"), none, 1.0).collect() == []


def test_neighbours_keep_the_r_eps_contract(spark):
    x = clustered(400, 16, 10, 8)
    df, q = cloud(spark, x), cloud(spark, x[:40])
    d = np.sqrt(((x[:40, None] - x[None]) ** 2).sum(2))
    r, eps = 2.0, 0.25
    b = VL.bands_for_recall(VL.euclidean_agreement(r, 1.0, 16), 4, 0.99)
    got = {(g.qid, g.id): g.l2 for g in VL.near_neighbors(q, df, 4, b, 1.0, r, 3, eps=eps).collect()}
    assert max(got.values()) <= (1 + eps) * r and any(v > r for v in got.values())
    near = {(i, j) for i, j in zip(*np.nonzero(d <= r))}
    assert len(near & set(got)) >= 0.97 * len(near)


def test_band_keys_of_many_bits_and_numbers():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (50, 7, 12))
    assert (VL._packed(bits) == (bits << np.arange(12)).sum(2)).all()
    h = rng.integers(-3, 4, (2000, 3, 4))
    key = VL._packed(h)
    for b in range(3):
        assert len(np.unique(key[:, b])) == len(np.unique(h[:, b], axis=0))


def test_a_query_with_many_bands_is_compiled(spark, capfd):
    """46 bands of 6 bits are one function, not 276 expressions that outgrow a method."""
    x = clustered(300, 16, 5, 1)
    VL.cosine_lsh_pairs(cloud(spark, x), 6, 46, 0.4, 7).count()
    assert "64 KB" not in capfd.readouterr().err
