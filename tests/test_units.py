"""Hand-sized cases (FIXTURES.md) and parser round trips."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F


# ---------------------------------------------------------------- near duplicates
def _sets(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, shingles array<bigint>")


def test_boundary_identical_unrelated(spark):
    from tessera.operators import lsh
    a = list(range(1, 19))                      # 18 ids
    b = list(range(1, 18)) + [19, 20]           # |a&b| = 17, |a|b| = 20 -> 0.85 exactly
    c = list(range(100, 130))                   # unrelated
    rows = [(1, a), (2, b), (3, c), (4, list(a))]  # 4 is identical to 1
    sets = _sets(spark, rows)
    exact = {(r.doc_a, r.doc_b): r.jaccard for r in lsh.exact_similar_pairs_from_sets(sets, 0.85).collect()}
    assert exact == {(1, 2): 0.85, (1, 4): 1.0}   # boundary included, 4 reported against its representative
    approx = {(r.doc_a, r.doc_b) for r in lsh.near_dup_pairs_from_sets(sets).collect()}
    assert approx <= set(exact) and (1, 4) in approx


def test_short_null_duplicate_id_documents(spark):
    from tessera.operators import lsh
    docs = spark.createDataFrame(
        [(1, "a b c d e f g"), (2, "a b"), (3, None), (5, "a b c d e f g"), (5, "x y z w")],
        "doc_id bigint, text string")
    s = {r.doc_id: r.shingles for r in lsh.shingle(docs).collect()}
    assert len(s[2]) == 1 and 3 not in s        # two words are one shingle; null text gives no set
    p = {(r.doc_a, r.doc_b) for r in lsh.near_dup_pairs(docs).collect()}
    assert (1, 5) in p
    assert all(a < b for a, b in p)             # never (d, d)


def test_shingle_ids_match_jvm_expression(spark):
    from tessera.operators import lsh
    docs = spark.createDataFrame([(1, "  The quick\tbrown Fox  jumps\nover the lazy dog  "),
                                  (2, "Élan vital à la française, très bien"), (3, "one two")],
                                 "doc_id bigint, text string")
    py = {r.doc_id: sorted(r.shingles) for r in lsh.shingle(docs).collect()}
    jvm = {r.doc_id: sorted(r.shingles) for r in lsh.shingle_jvm(docs).collect()}
    assert py == jvm and set(py) == {1, 2, 3}


def test_minhash_matches_bruteforce(spark):
    from tessera.functions.hashing import hash_coefficients
    from tessera.operators import lsh
    rng = np.random.default_rng(0)
    rows = [(i, [int(x) for x in rng.integers(2 ** 60, size=n)]) for i, n in
            enumerate([1, 5, 40000, 3])]
    sig = {r.doc_id: r.sig for r in lsh.minhash(_sets(spark, rows), 16, 9).collect()}
    a, b = hash_coefficients(16, 9)
    for i, s in rows:
        ref = [min((int(a[h]) * x + int(b[h])) % 2 ** 64 >> 3 for x in s) for h in range(16)]
        assert sig[i] == ref


def test_hot_bucket_is_tiled_and_exact(spark):
    from tessera.operators.joins import bucket_self_pairs
    rows = spark.createDataFrame([(0, 7, i) for i in range(300)] + [(1, 8, 1000), (1, 8, 1001)],
                                 "band int, key bigint, doc_id bigint")
    p = bucket_self_pairs(rows, ["band", "key"], "doc_id", block=16).collect()
    got = {(r.a, r.b) for r in p}
    assert len(p) == len(got) == 300 * 299 // 2 + 1


def test_pair_f1_edge_cases(spark):
    from tessera.operators import lsh
    e = spark.createDataFrame([], "doc_a bigint, doc_b bigint")
    t = spark.createDataFrame([(1, 2)], "doc_a bigint, doc_b bigint")
    r = lsh.pair_f1(e, t).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (0, 0, 1, 0.0, 0.0, 0.0)
    r = lsh.pair_f1(t.union(t), t).first()     # duplicates counted once
    assert (r.tp, r.fp, r.fn, r.f1) == (1, 0, 0, 1.0)


def test_connected_groups(spark):
    from tessera.operators.lsh import connected_groups
    e = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (3, 4)], "doc_a bigint, doc_b bigint")
    g = {r.doc_id: r.group_id for r in connected_groups(e).collect()}
    assert g == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10}
    chain = spark.createDataFrame([(i + 1, i) for i in range(1, 300)], "doc_a bigint, doc_b bigint")
    g = {r.doc_id: r.group_id for r in connected_groups(chain).collect()}
    assert set(g.values()) == {1} and len(g) == 300   # long chain converges by pointer jumping


# ---------------------------------------------------------------- parsers / map-reduce
def test_parsers(spark, tmp_path):
    from tessera.sources import lines as L
    sh = spark.createDataFrame([("PAGE_12 5 7 5",), ("PAGE_3",)], "value string")
    r = L.parse_shingle_lines(sh).collect()
    assert len(r) == 1 and r[0].doc_id == 12 and sorted(r[0].shingles) == [5, 7]
    log = spark.createDataFrame([("17 0.1 0.2 0.3 0.4 0.5 0.6 42 1 40 41 42",)], "value string")
    b = L.parse_bandit_log(log).first()
    assert (b.t, b.chosen, b.reward, b.choices) == (17, 42, 1, [40, 41, 42]) and len(b.z) == 6
    p = tmp_path / "truth.csv"
    p.write_text("5,3\n 1, 2\n")
    assert sorted(tuple(x) for x in L.read_pairs(spark, str(p)).collect()) == [(1, 2), (3, 5)]
    lab = spark.createDataFrame([("-1 0.5 2.0",)], "value string")
    v = L.parse_labeled_lines(lab).first()
    assert v.y == -1.0 and v.x == [0.5, 2.0]


def test_map_reduce_key_check(spark):
    from pyspark.sql import types as T
    from tessera.operators.mapreduce import map_reduce
    df = spark.createDataFrame([("a b a",)], "value string")
    with pytest.raises(TypeError):
        map_reduce(df, lambda k, v: [], lambda k, vs: [], T.ArrayType(T.LongType()), T.LongType(), "k string")
    out = map_reduce(df, lambda _, v: ((w, 1) for w in v.split()), lambda k, vs: [(k, sum(vs))],
                     T.StringType(), T.LongType(), "word string, cnt bigint")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2), ("b", 1)]


# ---------------------------------------------------------------- linear
def test_poly2_d2(spark):
    from tessera.functions.features import poly2
    x, y = 3.0, 2.0
    r = spark.createDataFrame([([x, y],)], "x array<double>").select(poly2("x").alias("f")).first().f
    s2 = math.sqrt(2)
    assert np.allclose(r, [x * x, s2 * x * y, s2 * x * y, y * y])


def test_zero_score_and_unit_margin(spark):
    from tessera.operators import linear as L
    df = spark.createDataFrame([(1, 1.0, [1.0, 0.0]), (2, -1.0, [0.0, 1.0])], "id bigint, y double, x array<double>")
    acc = L.svm_accuracy(L.svm_score(df, np.zeros(2))).first()
    assert acc.accuracy == 0.0                  # zero score counts as wrong
    s = L.svm_score(df, np.array([1.0, -1.0]))
    assert L.margin_violators(s).count() == 0    # margin exactly 1 is not a violation


def test_l1_projection_matches_numpy(spark):
    from tessera.operators import linear as L
    v = np.array([0.5, -0.2, 0.1, -0.9, 0.0])
    m = L.l1_projection(L.model_table(spark, v), 1.0)
    got = np.array([r.w for r in m.orderBy("j").collect()])
    assert np.allclose(got, L.l1_project_np(v, 1.0)) and abs(np.abs(got).sum() - 1.0) < 1e-9


# ---------------------------------------------------------------- clustering
def test_tie_empty_cluster_all_equal(spark):
    from tessera.operators import cluster as K
    pts = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0])], "id bigint, x array<double>")
    cen = (np.array([0, 1, 2], dtype=np.int32), np.array([[1.0, 0.0], [-1.0, 0.0], [50.0, 50.0]]))
    a = K.nearest_center(pts, cen).collect()
    assert {r.cid for r in a} == {0}            # tie -> lowest cid
    _, newC = K.kmeans_update(K.nearest_center(pts, cen), cen)
    assert np.allclose(newC[2], [50.0, 50.0])   # empty cell keeps its centre
    q = K.coreset_probs(pts, (np.array([0], dtype=np.int32), np.array([[0.0, 0.0]]))).collect()
    assert np.allclose([r.q for r in q], [0.5, 0.5])  # c_phi = 0 -> 4n/n_cell term only


# ---------------------------------------------------------------- bandits
def _arms(spark):
    return spark.createDataFrame([(1, [0.1] * 6), (2, [0.2] * 6), (3, [0.3] * 6)], "arm bigint, x array<double>")


def test_bandit_edge_cases(spark):
    from tessera.operators import bandit as BD
    log = spark.createDataFrame([(1, [0.5] * 6, 3, 0, [1, 2]), (2, [0.5] * 6, 2, 1, [2])],
                                "t bigint, z array<double>, chosen bigint, reward int, choices array<bigint>")
    st = BD.train_state(log.where("false"), _arms(spark), BD.LinUcbPolicy("disjoint"))
    p = log.withColumn("p", BD.pick_udf(st)(F.col("z"), F.col("choices"))).collect()
    assert p[0].p.arm == 1 and p[0].p.pos == 0  # tie between equal UCBs -> first candidate
    assert p[1].p.arm == 2                      # one candidate only
    none = BD.replay_ctr(BD.replay_accept(log.withColumn("picked", F.lit(99)))).collect()
    assert none == [] or none[0].ctr == 0.0     # no accepted rows -> CTR 0
    rc = log.select(BD.reward_recode(F.col("reward")).alias("r")).collect()
    assert [r.r for r in rc] == [-1, 1]


def test_hybrid_state_is_order_free(spark):
    """D12 = I5: the sequential replay's final state equals the telescoped sums
    over the rows it accepted."""
    import pandas as pd
    from tessera.operators import bandit as BD
    rng = np.random.default_rng(1)
    arms = spark.createDataFrame([(a, [float(v) for v in rng.random(6)]) for a in range(5)],
                                 "arm bigint, x array<double>")
    rows = [(t, [float(v) for v in rng.random(6)], int(rng.integers(5)), int(rng.integers(2)), list(range(5)))
            for t in range(150)]
    for kind in ("hybrid", "hybrid_concat", "disjoint"):
        pol = BD.LinUcbPolicy(kind, 0.2)
        # every row accepted: use a policy-free replay by matching chosen
        pdf = pd.DataFrame(rows, columns=["t", "z", "chosen", "reward", "choices"])
        pdf["choices"] = pdf["chosen"].map(lambda c: [c])
        player = BD.Player(pol, BD.arms_dict(arms))
        acc, rsum = player.play(pdf)
        st_seq = player.scorer.st
        assert acc == 150
        log = spark.createDataFrame(rows, "t bigint, z array<double>, chosen bigint, reward int, choices array<bigint>")
        st_sum = BD.train_state(log, arms, pol)
        for a in st_seq.A:
            assert np.allclose(st_seq.A[a], st_sum.A[a]) and np.allclose(st_seq.b[a], st_sum.b[a])
        if st_seq.A0 is not None:
            assert np.allclose(st_seq.A0, st_sum.A0, atol=1e-8) and np.allclose(st_seq.b0, st_sum.b0, atol=1e-8)


# ---------------------------------------------------------------- edit distance
def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_edit_distance_bruteforce(spark):
    import __spark_entry__ as E
    from tests.conftest import SF0001
    r = E.queries()["edit_distance"](spark, SF0001).orderBy("conv_id", "turn").limit(5).collect()
    c = spark.read.parquet(f"{SF0001}/conversations.parquet")
    texts = {(x.conv_id, x.turn): x.text for x in c.collect()}
    assert r
    for row in r:
        assert row.edits == _lev(texts[(row.conv_id, row.turn)], texts[(row.conv_id, row.turn + 1)])


def test_connected_groups_on_shuffled_paths(spark):
    import random

    from tessera.operators.lsh import connected_groups
    ids = list(range(400))
    random.Random(1).shuffle(ids)
    e = spark.createDataFrame(list(zip(ids, ids[1:])), "doc_a bigint, doc_b bigint")
    g = connected_groups(e).collect()
    assert len(g) == 400 and {r.group_id for r in g} == {0}


def test_hybrid_state_without_arrow(spark):
    import numpy as np

    from tessera.operators import bandit as BD
    st = BD.LinUcbState(BD.LinUcbPolicy("hybrid"), {1: np.ones(6), 2: np.zeros(6)})
    st.A0, st.b0 = np.eye(36), np.zeros(36)
    st.arm(1)
    old = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        r = BD.state_long(spark, st)
        assert r.where("arm IS NULL").count() == 36 * 36 + 36
        assert r.where("arm = 1").count() == 36 + 6 + 6 * 36
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", old)


def test_rank_one_learning_equals_direct_sums():
    import numpy as np

    from tessera.operators import bandit as BD
    rng = np.random.default_rng(0)
    arms = {a: rng.random(6) for a in range(4)}
    st = BD.LinUcbState(BD.LinUcbPolicy("hybrid"), arms)
    st.A0, st.b0 = np.eye(36), np.zeros(36)
    sc = BD._Scorer(st)
    rows = [(int(rng.integers(4)), rng.random(6), float(rng.integers(2))) for _ in range(200)]
    for a, u, r in rows:
        sc.learn(a, u, r)
    A0, b0 = np.eye(36), np.zeros(36)
    for a in arms:
        mine = [(u, BD.z_of("hybrid", u, arms[a]), r) for k, u, r in rows if k == a]
        X, Z, R = (np.array([m[i] for m in mine]) for i in range(3))
        A = np.eye(6) + X.T @ X
        A0 += Z.T @ Z - Z.T @ X @ np.linalg.solve(A, X.T @ Z)
        b0 += Z.T @ R - Z.T @ X @ np.linalg.solve(A, X.T @ R)
    assert np.allclose(st.A0, A0) and np.allclose(st.b0, b0) and np.allclose(sc.A0inv, np.linalg.inv(A0))


def test_parsers_drop_and_count_bad_lines(spark):
    from tessera.sources import lines as L
    df = spark.createDataFrame([("PAGE_1 5 7",), ("PAGE_x 5 7",), ("PAGE_1 5 foo",), ("",), (None,)], "value string")
    assert [tuple(r) for r in L.parse_shingle_lines(df).collect()] == [(1, [5, 7])]
    assert tuple(L.count_rejects(df, L.parse_shingle_lines).first()) == (5, 1, 4)
    df = spark.createDataFrame([("+1 0.5 1",), ("+1 0.5 bad",), ("x 1",)], "value string")
    assert [tuple(r) for r in L.parse_labeled_lines(df).collect()] == [(1.0, [0.5, 1.0])]
    df = spark.createDataFrame([("9 1 0 0 0 0 0 3 1 3 4",), ("9 1 0 0 q 0 0 3 1 3 4",)], "value string")
    assert [r.choices for r in L.parse_bandit_log(df).collect()] == [[3, 4]]
    df = spark.createDataFrame([("7 1 2",), ("a 1 2",)], "value string")
    assert [tuple(r) for r in L.parse_arm_lines(df).collect()] == [(7, [1.0, 2.0])]


def test_hot_bucket_is_tiled_before_its_shuffle(spark):
    from tessera.operators import joins as J
    rows = spark.createDataFrame([(1 if i < 90 else i, i) for i in range(200)], "key bigint, id bigint")
    got = {(r.a, r.b) for r in J.bucket_self_pairs(rows, ["key"], "id", block=16).collect()}
    assert got == {(i, j) for i in range(90) for j in range(i + 1, 90)}
    right = rows.where("id % 3 = 0").selectExpr("key", "id + 1000 as other")
    got = {(r.id, r.other) for r in J.bucket_cross_pairs(rows, right, ["key"], "id", "other", block=16).collect()}
    want = {(i, j + 1000) for i in range(200) for j in range(0, 200, 3) if (1 if i < 90 else i) == (1 if j < 90 else j)}
    assert got == want
    tiled = J._with_blocks(rows, ["key"], "id", 16)
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(key" not in plan.split("InMemoryRelation")[0].split("BroadcastExchange")[0]
