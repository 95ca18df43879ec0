import numpy as np

from tessera.operators import bandit as BD


def test_regret_runs_on_over_segments(spark, monkeypatch):
    monkeypatch.setattr(BD, "CARRY", 3)
    rng = np.random.default_rng(2)
    rows = [(t, t // 5, int(rng.integers(0, 4)), int(rng.integers(0, 2))) for t in range(63) if t // 5 != 4]
    log = spark.createDataFrame(rows, "t bigint, segment bigint, chosen bigint, reward int").repartition(7)
    mean = {a: np.mean([r[3] for r in rows if r[2] == a]) for a in range(4)}
    want = np.cumsum([max(mean.values()) - mean[r[2]] for r in rows])
    got = [r.regret for r in BD.cumulative_regret(log, carry=True).orderBy("t").collect()]
    assert np.allclose(got, want)
    assert not np.allclose([r.regret for r in BD.cumulative_regret(log).orderBy("t").collect()], want)
