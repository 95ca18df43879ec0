import numpy as np

from tessera.llm import embedding_dedup as E
from tests.llm.test_simhash import brute_components  # noqa: F401


def brute(ids, x, t):
    s = x @ x.T >= t
    np.fill_diagonal(s, False)
    lab = np.array(ids)
    while True:
        new = np.array([min(lab[i], *lab[s[i]]) if s[i].any() else lab[i] for i in range(len(ids))])
        if (new == lab).all():
            return s.sum(axis=1), lab
        lab = new


def test_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows, x, ids = [], [], []
    for c, (size, noise) in enumerate([(120, 0.02), (60, 0.035), (40, 0.045), (30, 0.0), (20, 0.055), (10, 0.1)]):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        for k in range(size):
            x.append(base + noise * rng.normal(size=64))
    x += list(rng.normal(size=(400, 64)))
    x = np.array(x, dtype=np.float32).astype(np.float64)
    ids = rng.permutation(5000)[:len(x)].tolist()
    rows = [(i, (v * (1 + i % 7)).tolist()) for i, v in zip(ids, x)]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    odd = [(9001, None), (9002, []), (9003, [0.0] * 64), (9004, [None] + [1.0] * 63), (9005, [float("nan")] * 64), (9006, [float("inf")] + [0.0] * 63),
           (9007, [1.0, 0.0]), (9008, [2.0, 0.01]), rows[0], (None, rows[1][1])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as ball", "2 as key", "3 as v")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.linked_vectors(df).collect()}
    assert len(got) == len(rows) + 8
    for i in range(9001, 9007):
        assert got[i] == (0, i, True)
    assert got[9007] == (1, 9007, True) and got[9008] == (1, 9007, False)
    n, lab = brute(ids, u, 0.95)
    want = {i: (int(k), int(c), i == c) for i, k, c in zip(ids, n, lab)}
    wrong = [i for i in want if got[i] != want[i]]
    assert sum(n) > 15000 and len(wrong) <= len(ids) * 0.01, (len(wrong), [(got[i], want[i]) for i in wrong[:5]])
    assert all(got[i][0] <= want[i][0] for i in want)


def test_empty_and_single(spark):
    e = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert E.linked_vectors(e).count() == 0
    one = spark.createDataFrame([(5, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in E.linked_vectors(one).collect()] == [(5, 0, 5, True)]


def test_calibration_reaches_its_recall():
    for n in (100, 10_000, 10**9):
        depth, tables = E.calibrate(n, 0.3162, 0.99)
        p = E._same_cell(0.3162, E.CELL) ** depth
        assert 1 - (1 - p) ** tables >= 0.99
        assert n * E._same_cell(2**0.5, E.CELL) ** depth <= 1
    rng = np.random.default_rng(0)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=(4000, 64))
    o -= (o * a).sum(axis=1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * o
    depth, tables = E.calibrate(10_000, 0.3162)
    same = (E.cell_keys(a, depth, tables, 1) == E.cell_keys(b, depth, tables, 1)).any(axis=1)
    assert same.mean() > 0.985
    q = E.directions(64, E.POOL, 3)
    hits = (np.abs(a @ q - b @ q) <= 2 * 0.3162).sum(axis=1)
    assert (hits >= E.least_count(E.POOL, 0.9545)).mean() > 0.999
