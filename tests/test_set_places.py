"""Candidates of the set join come from packed prefixes, chance pairs are ruled out by parity
maps, and a set is sent once for its cluster, not once for every pair."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators import lsh, set_join


def _sets(rng, clusters=12, copies=9):
    """Clusters of near copies; one id is in all sets."""
    out = {}
    for c in range(clusters):
        base = rng.integers(0, 1 << 59, int(rng.integers(20, 400)))
        for k in range(copies):
            own = np.where(rng.random(len(base)) < 0.04 * k, rng.integers(0, 1 << 59, len(base)), base)
            out[100 * c + k] = sorted({7, *own.tolist()})
    return out


def _jaccard(sets):
    return {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a < b}


def _frame(spark, sets):
    return spark.createDataFrame(list(sets.items()), "doc_id bigint, shingles array<bigint>").repartition(3)


def test_packed_entries_give_the_pairs_and_take_few_bytes(spark, monkeypatch):
    sets = _sets(np.random.default_rng(1))
    true = {k for k, v in _jaccard(sets).items() if v >= 0.5}
    df = _frame(spark, sets)
    for listed in (set_join.LISTED, 4):     # crowded tokens by the tiled join
        monkeypatch.setattr(set_join, "LISTED", listed)
        found = {tuple(r) for r in lsh.prefix_candidates(df, 0.5).collect()}
        assert true <= found and all(a < b for a, b in found)
    rng, n, per = np.random.default_rng(2), 1000, 250
    own = np.repeat(np.arange(n), per)
    packed = list(set_join.pack_entries(rng.integers(0, 1 << 40, n), np.full(n, 2 * per), own, rng.integers(0, 1 << 60, n * per), np.tile(np.arange(per), n), 16))
    assert sum(len(x) for _, x in packed) < 9 * n * per     # a row has 40 bytes
    assert sorted(g for g, _ in packed) == list(range(16))


def test_maps_rule_out_chance_pairs_and_no_other(spark):
    sets = _sets(np.random.default_rng(3))
    sets |= {5000 + k: [7] for k in range(2)} | {6000: [7, 8], 6001: [7, 9]}
    j = _jaccard(sets)
    every = spark.createDataFrame(list(j), "doc_a bigint, doc_b bigint")
    for t in (0.5, 0.85):
        kept = {tuple(r) for r in lsh.possible_pairs(every, _frame(spark, sets), t).collect()}
        assert {k for k, v in j.items() if v >= t} <= kept
        assert sum(j[k] < t - 0.2 for k in kept) < 0.1 * len(j)


def test_pairs_of_a_cluster_meet_in_one_place_and_are_exact(spark, monkeypatch):
    sets = _sets(np.random.default_rng(4))
    j = {k: v for k, v in _jaccard(sets).items() if k[0] // 100 == k[1] // 100}
    pairs = spark.createDataFrame(list(j), "doc_a bigint, doc_b bigint")
    monkeypatch.setattr(lsh, "materialize", lambda df: df.cache())
    _, sent = lsh._places(pairs, 1000.0)
    assert sent.count() == len(sets)        # 8 partners each: before, a set went with every pair
    for block in (lsh.VERIFY_BLOCK, 3):
        monkeypatch.setattr(lsh, "VERIFY_BLOCK", block)
        got = {(r.doc_a, r.doc_b): r.jaccard for r in lsh.verify_pairs(pairs, _frame(spark, sets)).collect()}
        assert got == j


def test_repeated_ids_and_pairs_keep_their_rows():
    sets = pa.table({"doc_id": [1, 2, 2, 3], "shingles": [[1, 2], [1, 2], [2, 5], [9]]})
    pairs = pa.table({"doc_a": [1, 1, 1, 1], "doc_b": [2, 3, 2, 8]})
    got = sorted(zip(*set_join.compare(pairs, sets).to_pydict().values()))
    assert got == [(1, 2, 1 / 3), (1, 2, 1 / 3), (1, 2, 1.0), (1, 2, 1.0), (1, 3, 0.0)]
    assert set_join.compare(pairs, sets.slice(0, 0)).num_rows == 0


def test_distinct_contents_are_taken_without_shuffling_sets(spark):
    rows = [(1, [1, 2], "10"), (2, [1, 2], "10"), (3, [3], "20"), (3, [3], "20"), (3, [1, 2], "10"), (None, [4], "30"), (4, [], "40")]
    df = spark.createDataFrame([(d, s, k * 16) for d, s, k in rows], "doc_id bigint, shingles array<bigint>, skey string")
    one, members = lsh.distinct_sets(df)
    assert sorted(r.shingles for r in one.collect()) == [[1, 2], [3]]
    assert sorted((r.id, r.c) for r in members.collect()) == [(1, 1), (2, 1), (3, 1), (3, 2)]
    once, _ = lsh.distinct_sets(df.where("doc_id < 3"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and once.select(F.size("shingles")).count() == 1
