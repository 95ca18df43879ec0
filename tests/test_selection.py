"""The threshold selection draws the rows of the ordered limit, ties and repeats included."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import sampling as S


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 40, 333, 999, 1000, 1500])
def test_sample_equals_the_ordered_limit(spark, monkeypatch, n):
    pts = spark.range(1000).selectExpr("id * 7919 as id", "cast(id % 13 as double) * if(id % 3 = 0, 1e-9, 1e6) as w", "id as x").repartition(5)
    want, want_u = S.weighted_sample(pts, "w", n, 3), S.uniform_sample(pts, n, 5)
    want, want_u = rows_of(want), rows_of(want_u)
    monkeypatch.setattr(S, "TOP_ROWS", 0)
    for buckets in (2, 16, 4096):
        monkeypatch.setattr(S, "BUCKETS", buckets)
        assert rows_of(S.weighted_sample(pts, "w", n, 3)) == want
        assert rows_of(S.uniform_sample(pts, n, 5)) == want_u
    assert len(want_u) == min(n, 1000)


def test_ties_repeats_and_wide_ids(spark, monkeypatch):
    rng = random.Random(2)
    data = [(rng.choice([0.0, 0.5, 0.5000000000000001, 3e300]), rng.choice([-2**63, -5, 2**62, 2**62 + 1, 7]), "x") for _ in range(400)]
    df = spark.createDataFrame(data, "k double, id bigint, extra string")
    for n in (1, 55, 120, 250, 399):
        want = [r[:2] for r in sorted(data)]
        monkeypatch.setattr(S, "TOP_ROWS", 0)
        got, after = S.smallest(df, "k", "id", n)
        assert sorted((r.k, r.id) for r in got.collect()) == want[:n]
        assert after == want[n][0]
    got, after = S.smallest(df, "k", "id", 400)
    assert got.count() == 400 and after is None


def test_no_large_result_reaches_one_place(spark, monkeypatch):
    """The chosen rows are a filter of the input: no global sort, limit or single partition."""
    monkeypatch.setattr(S, "TOP_ROWS", 0)
    got, _ = S.smallest(spark.range(50_000).selectExpr("id", "cast(hash(id) as double) as k").repartition(6), "k", "id", 20_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan
    assert got.count() == 20_000


def test_rows_without_weight_or_id_are_never_drawn(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (None, 5.0), (3, -1.0), (4, 1e-320)], "id bigint, w double")
    assert [r.id for r in S.weighted_sample(df, "w", 3, 1).collect()] == [4]
    assert S.weighted_sample(df.where(F.lit(False)), "w", 3, 1).count() == 0
