"""Whole-log replay equals one plain sequential pass for every policy, in any segments and after a stop."""

import math

import numpy as np
import pytest

from tessera.functions.hashing import py_uniform
from tessera.operators import bandit as BD
from tessera.operators.replay import replay_whole

KINDS = [("disjoint", 0.2), ("concat", 0.2), ("hybrid_concat", 0.2), ("hybrid", 0.2), ("ucb1", 0.0), ("epsilon_greedy", 5.0)]


def plain(log, arms, kind, alpha, seed):
    """The policies by their textbook formulas, with fresh inverses for every event."""
    acc = rew = n = 0
    cnt, mean, A, b, B = {}, {}, {}, {}, {}
    d = 6
    dz = {"hybrid": d * d, "hybrid_concat": d}.get(kind, 0)
    A0, b0 = np.eye(dz), np.zeros(dz)
    trail = []
    for t, z, choices, chosen, reward in log:
        n += 1
        z = np.array(z)
        if kind == "ucb1":
            score = [mean[a] + math.sqrt(2 * math.log(n) / cnt[a]) if a in cnt else math.inf for a in choices]
            pick = choices[int(np.argmax(score))]
        elif kind == "epsilon_greedy":
            if py_uniform(seed, "eps", t) < min(1.0, alpha / n):
                pick = choices[int(py_uniform(seed, "epsarm", t) * len(choices))]
            else:
                pick = choices[int(np.argmax([mean.get(a, 0.0) for a in choices]))]
        else:
            beta = np.linalg.solve(A0, b0) if dz else None
            A0i = np.linalg.inv(A0) if dz else None
            score = []
            for a in choices:
                art = np.array(arms[a])
                x = {"concat": np.concatenate([z, art]), "hybrid_concat": np.concatenate([art, z])}.get(kind, z)
                Ai = np.linalg.inv(A.get(a, np.eye(len(x))))
                ba = b.get(a, np.zeros(len(x)))
                if not dz:
                    score.append(x @ Ai @ ba + alpha * math.sqrt(x @ Ai @ x))
                    continue
                zz = z if kind == "hybrid_concat" else np.outer(z, art).ravel()
                Ba = B.get(a, np.zeros((len(x), dz)))
                th = Ai @ (ba - Ba @ beta)
                s = zz @ A0i @ zz - 2 * zz @ A0i @ Ba.T @ Ai @ x + x @ Ai @ x + x @ Ai @ Ba @ A0i @ Ba.T @ Ai @ x
                score.append(zz @ beta + x @ th + alpha * math.sqrt(max(s, 0.0)))
            pick = choices[int(np.argmax(score))]
        if pick == chosen:
            acc, rew = acc + 1, rew + reward
            if kind in ("ucb1", "epsilon_greedy"):
                cnt[pick] = cnt.get(pick, 0) + 1
                mean[pick] = mean.get(pick, 0.0) + (reward - mean.get(pick, 0.0)) / cnt[pick]
            else:
                art = np.array(arms[pick])
                x = {"concat": np.concatenate([z, art]), "hybrid_concat": np.concatenate([art, z])}.get(kind, z)
                r = -1.0 if kind == "hybrid" and reward == 0 else float(reward)
                if dz:
                    zz = z if kind == "hybrid_concat" else np.outer(z, art).ravel()
                    Aa, Ba, ba = A.get(pick, np.eye(len(x))), B.get(pick, np.zeros((len(x), dz))), b.get(pick, np.zeros(len(x)))
                    A0 += Ba.T @ np.linalg.solve(Aa, Ba)
                    b0 += Ba.T @ np.linalg.solve(Aa, ba)
                    Aa, Ba, ba = Aa + np.outer(x, x), Ba + np.outer(x, zz), ba + r * x
                    A0 += np.outer(zz, zz) - Ba.T @ np.linalg.solve(Aa, Ba)
                    b0 += r * zz - Ba.T @ np.linalg.solve(Aa, ba)
                    A[pick], B[pick], b[pick] = Aa, Ba, ba
                else:
                    A[pick] = A.get(pick, np.eye(len(x))) + np.outer(x, x)
                    b[pick] = b.get(pick, np.zeros(len(x))) + r * x
        trail.append((acc, rew))
    return trail


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    arms = {a: rng.normal(size=6).tolist() for a in range(12)}
    log = []
    for t in range(5000):
        choices = rng.choice(12, 5, replace=False).tolist()
        z = rng.normal(size=6).tolist()
        chosen = int(rng.choice(choices))
        log.append((t, z, choices, chosen, int(rng.random() < 0.2 + 0.05 * chosen)))
    return log, arms


def frames(spark, data):
    log, arms = data
    return (spark.createDataFrame(log, "t bigint, z array<double>, choices array<bigint>, chosen bigint, reward bigint").repartition(7),
            spark.createDataFrame(sorted(arms.items()), "arm bigint, x array<double>"))


def test_equals_one_pass_for_every_policy(spark, data, tmp_path):
    log, arms = frames(spark, data)
    pols = [BD.LinUcbPolicy(k, a) for k, a in KINDS]
    got = replay_whole(log, arms, pols, 1300, 3).collect()
    assert len(got) == 6 * 4
    for pid, (kind, alpha) in enumerate(KINDS):
        want, before = plain(*data, kind, alpha, 3), (0, 0)
        for k in range(4):
            end = want[min(1300 * (k + 1), 5000) - 1]
            r = next(r for r in got if r.pid == pid and r.segment == k)
            assert (r.kind, r.accepted, r.reward_sum) == (kind, end[0] - before[0], end[1] - before[1]), (kind, k)
            assert abs(r.ctr - end[1] / end[0]) < 1e-12
            before = end

    # other segments, and a run that is stopped after two of them and called again
    folder = str(tmp_path / "r")
    fast = [pols[0], pols[4], pols[5]]
    half = replay_whole(log, arms, fast, 1000, 3, folder, stop_after=2)
    assert {r.segment for r in half.collect()} == {0, 1}
    again = replay_whole(log, arms, fast, 1000, 3, folder)
    last = {r.kind: r.ctr for r in again.collect() if r.segment == 4}
    assert last == {r.kind: r.ctr for r in got if r.segment == 3 and r.kind in last}


def test_empty_log_and_odd_events(spark, data):
    log, arms = frames(spark, data)
    pols = [BD.LinUcbPolicy("disjoint", 0.2), BD.LinUcbPolicy("ucb1", 0.0)]
    assert replay_whole(log.where("false"), arms, pols).collect() == []
    odd = log.where("t < 50").unionByName(log.where("t < 3").selectExpr("cast(null as bigint) t", "z", "choices", "chosen", "reward"))
    odd = odd.unionByName(log.where("t = 60").selectExpr("t", "z", "cast(array() as array<bigint>) choices", "chosen", "reward"))
    r = replay_whole(odd, arms, pols, 20).collect()
    assert {x.segment for x in r} == {0, 1, 2, 3}


@pytest.mark.parametrize("kind", ["disjoint", "concat", "hybrid_concat", "hybrid"])
def test_batches_of_candidates_score_like_single_ones(spark, data, kind):
    log, arms = frames(spark, data)
    st = BD.train_state(log.where("t < 1000"), arms, BD.LinUcbPolicy(kind, 0.2))
    sc = BD._Scorer(st)
    some = data[0][1000:1200]
    users = np.repeat([e[1] for e in some], 6, axis=0)
    flat = np.array([a for e in some for a in [*e[2], 99]])                 # 99 has no features
    want = np.concatenate([sc.scores(np.array(e[1]), [*e[2], 99]) for e in some])
    assert np.allclose(sc.scores_many(users, flat), want)
    picks = {r.t: (r.p.arm, r.p.pos) for r in log.where("t >= 1000 AND t < 1200").withColumn("p", BD.pick_udf(st)("z", "choices")).collect()}
    assert picks == {e[0]: sc.pick(np.array(e[1]), e[2])[::2] for e in some}
    odd = log.where("t = 5").selectExpr("z", "cast(array() as array<bigint>) choices").unionByName(
        log.where("t = 6").selectExpr("z", "array(99L) choices")).unionByName(log.where("t = 7").selectExpr("z", "cast(null as array<bigint>) choices"))
    assert [r.p.arm for r in odd.withColumn("p", BD.pick_udf(st)("z", "choices")).collect()] == [-1, -1, -1]
