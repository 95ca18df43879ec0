"""Vector LSH joins compare inside the buckets: every link once, no row for a candidate."""

import numpy as np
import pytest

from tessera.operators import vector_lsh as VL
from tests.test_metric_join import cloud, clustered


def shared(x, W, r, hashes):
    """Pairs that share a bucket of any band."""
    h = hashes(x @ W.T)
    k = VL._packed(h.astype(np.int64).reshape(len(x), -1, r), h.dtype == bool)
    return (k[:, None] == k[None]).any(2)


@pytest.mark.parametrize("block", [VL.TILE, 20])
def test_links_are_the_candidates_above_the_limit(spark, block):
    x = clustered(300, 16, 6, 4, spread=1.5)
    x[:5] = x[5:10]                                       # copies
    x[20] = 0
    up = np.triu(np.ones((300, 300), bool), 1)
    W = VL.gaussian_matrix(4 * 12, 16, 7, "cos")
    rows = VL.cosine_lsh_pairs(cloud(spark, x), 4, 12, 0.4, 7, block).collect()
    n = np.linalg.norm(x, axis=1)
    cos = x @ x.T / np.maximum(np.outer(n, n), 1e-30)
    want = {(i, j) for i, j in zip(*np.nonzero(up & (cos >= 0.4) & shared(x, W, 4, lambda p: p >= 0)))}
    got = [(r.id_a, r.id_b) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want
    assert all(abs(r.cosine - cos[r.id_a, r.id_b]) < 1e-9 for r in rows)
    W, hashes = VL._e2lsh(16, 3, 8, 2.0, 7)
    rows = VL.euclidean_lsh_pairs(cloud(spark, x), 3, 8, 2.0, 8.0, 7, block).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = {(i, j) for i, j in zip(*np.nonzero(up & (d <= 8.0) & shared(x, W, 3, hashes)))}
    got = [(r.id_a, r.id_b) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want
    assert all(abs(r.l2 - d[r.id_a, r.id_b]) < 1e-9 for r in rows)


def test_vectors_are_not_joined_to_candidates(spark):
    """The old plan made a row for every candidate and joined both vectors to it."""
    df = cloud(spark, clustered(100, 8, 3, 1))
    for q in (VL.cosine_lsh_pairs(df, 2, 4, 0.4, 7), VL.euclidean_lsh_pairs(df, 2, 4, 1.0, 1.0, 7)):
        plan = q._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.count("FlatMapGroupsInArrow") == 1


def test_nulls_non_finite_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (None, [1.0, 0.0]),
                                (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0])], "id bigint, x array<double>").repartition(1)
    assert [(r.id_a, r.id_b) for r in VL.cosine_lsh_pairs(df, 1, 20, 0.9, 7).collect()] == [(1, 2), (1, 2)]
    assert [(r.id_a, r.id_b) for r in VL.euclidean_lsh_pairs(df, 1, 20, 1.0, 0.5, 7).collect()] == [(1, 2), (1, 2)]
    assert VL.cosine_lsh_pairs(df.where("false"), 2, 4, 0.4, 7).collect() == []


def test_keys_agree_between_batches():
    """A batch whose bucket numbers all happen to be 0 or 1 gets the keys it would get in any other."""
    h = np.array([[[0, 1]], [[1, 1]], [[5, -2]]])
    assert (VL._packed(h, False)[:2] == VL._packed(h[:2], False)).all()
