"""The exact set join sends prefixes only, and edges are computed once where they are scored."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import bandit as BD
from tessera.operators import lsh, pair_scoring


def _sets(spark, rng, n=120):
    """Near copies in clusters, some of frequent ids only."""
    sets = {}
    for i in range(n):
        base = np.random.default_rng(i // 4).integers(0, 1 << 59, 40)
        own = np.concatenate([base[:36], rng.integers(0, 1 << 59, int(rng.integers(0, 9)))])
        sets[i] = sorted({int(x) for x in (own if i % 3 else np.append(own[:5], np.arange(30)))})
    return sets, spark.createDataFrame(list(sets.items()), "doc_id bigint, shingles array<bigint>").repartition(5)


def _brute(sets, t):
    j = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a < b}
    return {k for k, v in j.items() if v >= t}


def test_exact_join_finds_every_pair_from_prefixes(spark):
    sets, df = _sets(spark, np.random.default_rng(1))
    for t in (0.5, 0.85, 1.0):
        sent = {}
        for r in lsh.prefixes(df, t).collect():
            sent.setdefault(r.doc_id, []).append(r.i)
            assert r.n == len(sets[r.doc_id])
        assert {k: sorted(v) for k, v in sent.items()} == {k: list(range(len(x) - int(np.ceil(len(x) * t - 1e-9)) + 1)) for k, x in sets.items()}
        found = {(r.doc_a, r.doc_b) for r in lsh.exact_similar_pairs_from_sets(df, t, collapse=False).collect()}
        assert found == _brute(sets, t) and found


def test_counters_put_frequent_ids_last(spark):
    df = spark.createDataFrame([(i, [7, 100 + i]) for i in range(50)], "doc_id bigint, shingles array<bigint>")
    assert {r.tok for r in lsh.prefixes(df, 1.0).collect()} == {100 + i for i in range(50)}
    assert lsh.slot_counts(df)[7] == 50 and lsh.slot_counts(df).sum() == 100
    assert lsh.slot_counts(df.limit(0)).sum() == 0 and lsh.prefixes(df.limit(0), 0.8).count() == 0


def test_representatives_with_repeated_and_null_ids(spark):
    rows = [(1, [1, 2]), (2, [1, 2]), (2, [3, 4]), (3, [3, 4]), (None, [5, 6]), (4, [5, 6]), (4, [5, 6])]
    reps, star = lsh.collapse_identical(spark.createDataFrame(rows, "doc_id bigint, shingles array<bigint>"))
    # id 2 represents [3, 4] and is a copy of 1: it stays, as before
    assert sorted((r.doc_id, r.shingles[0]) for r in reps.collect()) == [(1, 1), (2, 1), (2, 3), (4, 5), (4, 5)]
    assert sorted((r.doc_a, r.doc_b) for r in star.collect()) == [(1, 2), (2, 3)]


def test_group_scores_compute_edges_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    edges = spark.createDataFrame([(1, 3), (1, 5)], "doc_a bigint, doc_b bigint").coalesce(1).mapInArrow(count, "doc_a bigint, doc_b bigint")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (5, 5)], "doc_id bigint, rep bigint")
    groups = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in (1, 2, 3, 4, 5)], "doc_id bigint, group string")
    r = pair_scoring.f1_of_groups(edges, members, groups).first()
    assert (r.tp, r.fp, r.fn) == (3, 2, 3)
    assert seen.value == 2


def test_candidate_scores_score_events_not_rows(spark):
    rng = np.random.default_rng(2)
    arm = {a: rng.random(6) for a in range(5)}
    st = BD._Scorer(BD.LinUcbState(BD.LinUcbPolicy("disjoint"), arm)).st
    for _ in range(20):
        BD._Scorer(st).learn(int(rng.integers(0, 5)), rng.random(6), 1.0)
    rows = [(i, rng.random(6).tolist(), None if i == 3 else [int(a) for a in rng.permutation(7)[:i % 4]]) for i in range(30)]
    log = spark.createDataFrame(rows, "t bigint, z array<double>, choices array<bigint>").repartition(3)
    out = BD.candidate_scores(log, None, st)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("ArrowEvalPython")       # scored below, listed above
    got = {(r.t, r.pos): (r.arm, r.ucb) for r in out.collect()}
    sc = BD._Scorer(st)
    want = {(t, p): (a, sc.ucb(np.array(z), a)) for t, z, c in rows for p, a in enumerate(c or [])}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and (got[k][1] == want[k][1] or abs(got[k][1] - want[k][1]) < 1e-9) for k in want)
    best = {r.t: r.picked for r in BD.ucb_argmax(out).collect()}
    assert best == {t: c[int(np.argmax(sc.scores(np.array(z), c)))] for t, z, c in rows if c}
