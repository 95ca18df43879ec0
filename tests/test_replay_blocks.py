"""Replays read the log once: events up to the next accepted one are scored together, slices are handed on in lots."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import bandit as BD
from tessera.operators import replay as R


def events(n=900, arms=9):
    rng = np.random.default_rng(4)
    arm_x = {a: rng.normal(size=6) for a in range(arms)}
    rows = []
    for t in range(n):
        c = rng.choice(arms + 1, rng.integers(0, 6), replace=False).tolist()      # the last has no features
        rows.append((t, rng.normal(size=6).tolist(), c, int(rng.integers(arms)), int(rng.random() < 0.4)))
    return arm_x, pd.DataFrame(rows, columns=["t", "z", "choices", "chosen", "reward"])


@pytest.mark.parametrize("kind", ["disjoint", "concat", "hybrid_concat", "hybrid"])
def test_blocks_equal_single_events(kind, monkeypatch):
    arm_x, rows = events()
    one, many = (BD.Player(BD.LinUcbPolicy(kind, 0.2), arm_x, 3) for _ in range(2))
    for e in zip(rows["t"], rows["z"], rows["choices"], rows["chosen"], rows["reward"]):
        one.event(*e)
    calls = []
    block = BD._Scorer.pick_block
    monkeypatch.setattr(BD._Scorer, "pick_block", lambda self, *a: calls.append(1) or block(self, *a))
    many.play(rows)
    assert (one.seen, one.accepted, one.reward) == (many.seen, many.accepted, many.reward) and one.accepted > 50
    assert 0 < len(calls) < len(rows) / 2


def test_slices_equal_one_frozen_pass_a_slice(spark, monkeypatch):
    arm_x, rows = events()
    rows = rows[(rows["t"] < 300) | (rows["t"] >= 520)]                           # slices without events
    pol = BD.LinUcbPolicy("hybrid")
    log = spark.createDataFrame(list(rows.itertuples(index=False, name=None)), "t bigint, z array<double>, choices array<bigint>, chosen bigint, reward bigint")
    log = log.withColumn("t", log.t + 7).repartition(5)
    arms = spark.createDataFrame([(a, x.tolist()) for a, x in arm_x.items()], "arm bigint, x array<double>")
    want, done = [], []
    for t0 in range(0, 900, 100):
        sl = rows[(rows["t"] >= t0) & (rows["t"] < t0 + 100)]
        total = {}
        for part in done:
            for a, v in BD.row_sums("hybrid", part["chosen"].to_numpy(), np.where(part["reward"] == 0, -1.0, 1.0), np.stack(part["z"]),
                                    np.stack([arm_x[a] for a in part["chosen"]])):
                total[a] = total.get(a, 0) + v
        sc = BD._Scorer(BD.state_from_arrays(total, arm_x, pol))
        acc = sl[np.array([sc.pick(np.array(z), c)[0] == k for z, c, k in zip(sl["z"], sl["choices"], sl["chosen"])], dtype=bool)]
        done += [acc] if len(acc) else []
        want.append((t0 // 100, t0 + 7, len(acc), int(acc["reward"].sum())))
    assert sum(w[2] for w in want) > 50
    seen = []
    monkeypatch.setattr(R, "SLICES_LEN", 250)
    keep = R._stage
    monkeypatch.setattr(R, "_stage", lambda *a: seen.append(1) or keep(*a))
    got = BD.replay_minibatch(log, arms, pol, 100).orderBy("slice").collect()
    assert [tuple(r)[:4] for r in got] == want and len(seen) == 1
    assert BD.replay_minibatch(log.where("false"), arms, pol, 100).collect() == []


@pytest.mark.parametrize("kind", ["disjoint", "concat"])
def test_candidates_are_scored_once_a_block(kind, monkeypatch):
    arm_x, rows = events(1500)
    one, many = (BD.Player(BD.LinUcbPolicy(kind, 0.2), arm_x, 3) for _ in range(2))
    for e in zip(rows["t"], rows["z"], rows["choices"], rows["chosen"], rows["reward"]):
        one.event(*e)
    calls = []
    block = BD._Scorer.pick_block
    monkeypatch.setattr(BD._Scorer, "pick_block", lambda self, *a: calls.append(1) or block(self, *a))
    many.play(rows.sample(frac=1, random_state=1))
    assert (one.seen, one.accepted, one.reward) == (many.seen, many.accepted, many.reward) and one.accepted > 100
    assert all(np.allclose(one.scorer.st.A[a], many.scorer.st.A[a]) for a in one.scorer.st.A)
    assert len(calls) <= 1500 // BD.PLAYED_EVENTS + 1


def test_events_travel_in_lots():
    import pyarrow as pa
    from tessera.streaming import jobs as S
    _, rows = events()
    out = list(S._packed([pa.RecordBatch.from_pandas(rows), pa.RecordBatch.from_pandas(rows.iloc[:0])]))
    lots = [x for b in out for x in b.column(0).to_pylist()]
    assert len(lots) == 1
    back = pa.ipc.open_stream(lots[0]).read_all().to_pandas()
    assert back["t"].tolist() == rows["t"].tolist() and [list(c) for c in back["choices"]] == rows["choices"].tolist()
