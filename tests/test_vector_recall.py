"""Vector LSH queries find at least 0.9 of the brute-force links."""

import numpy as np

from tessera.plans import q_vector_lsh as Q
from tests.conftest import SF001


def vectors(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])


def recall(true, got):
    assert got <= true
    return len(got) / len(true)


def test_links_against_brute_force(spark):
    ids, x, label = vectors(spark)
    norm = np.linalg.norm(x, axis=1)
    cos = x @ x.T / np.outer(norm, norm)
    l2 = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    pairs = lambda m: {tuple(sorted((int(ids[i]), int(ids[j])))) for i, j in zip(*np.nonzero(np.triu(m, 1)))}
    got = {(r.id_a, r.id_b) for r in Q.euclidean_lsh_pairs(spark, SF001).collect()}
    assert recall(pairs(l2 <= Q.E_RAD), got) >= 0.9
    got = {(r.id_a, r.id_b) for r in Q.cosine_lsh_pairs(spark, SF001).collect()}
    assert recall(pairs(cos >= Q.COS_T), got) >= 0.9
    labels = np.unique(label)
    d = np.sqrt(((np.array([x[label == k].mean(0) for k in labels])[:, None] - x[None]) ** 2).sum(2))
    got = {(r.qid, r.id) for r in Q.near_neighbors(spark, SF001).collect()}
    assert recall({(int(labels[i]), int(ids[j])) for i, j in zip(*np.nonzero(d <= Q.NN_RAD))}, got) >= 0.9
