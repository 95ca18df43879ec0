import itertools
import math

import pytest
from pyspark.sql import types as T

from tessera.operators.mapreduce import map_reduce

L, S, D = T.LongType(), T.StringType(), T.DoubleType()


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _total():
    def total(k, values):                # a nested function travels by value
        yield k, sum(values)
    return total


total = _total()


def test_mapper_gets_whole_batches(spark, small_batches):
    """Batches of the mapper are its own: Arrow batches of 7 rows, mapper batches of 50."""
    df = spark.range(0, 230, 1, 1).selectExpr("id as value")

    def mapper(key, values):
        assert key is None and isinstance(values, list)
        yield len(values), sum(values)
    got = map_reduce(df, mapper, lambda k, vs: [(k, n, t) for n, t in [(0, 0)] for t in [sum(vs)]], L, L, "size bigint, n bigint, total bigint",
                     batch_size=50).collect()
    sizes = {r["size"] for r in got}
    assert sizes <= {50, 230 % 50} | set(range(1, 50)) and sum(r.total for r in got) == sum(range(230))
    alone = map_reduce(df.coalesce(1), lambda _, vs: [(len(vs), 1)], total, L, L, "size bigint, n bigint", batch_size=1000).collect()
    assert sum(r["size"] * r.n for r in alone) == 230


def test_a_hot_key_is_an_iterator_and_may_be_left_early(spark, small_batches):
    df = spark.range(20_000).selectExpr("if(id % 10 < 3, 'hot', concat('k', id % 50)) as value")

    def first_three(k, values):
        assert not hasattr(values, "__len__")
        yield k, len(list(itertools.islice(values, 3))), sum(1 for _ in values) if k != "hot" else -1
    got = {r.k: (r.a, r.b) for r in map_reduce(df, lambda _, v: [(v, 1)], first_three, S, L, "k string, a bigint, b bigint").collect()}
    assert got["hot"] == (3, -1) and all(a == 3 and b == 400 - 3 for k, (a, b) in got.items() if k != "hot")


def test_secondary_sort_and_salts(spark, small_batches):
    df = spark.range(3000).selectExpr("id as value").repartition(5)
    mapper = lambda _, v: [("a" if v % 3 else "b", (v * 7919) % 1000)]

    def in_order(k, values):
        seen = list(values)
        yield k, seen == sorted(seen), len(seen)
    assert sorted(map(tuple, map_reduce(df, mapper, in_order, S, L, "k string, ok boolean, n bigint", sort_values=True).collect())) == [
        ("a", True, 2000), ("b", True, 1000)]
    plain = sorted(map(tuple, map_reduce(df, mapper, total, S, L, "k string, n bigint").collect()))
    for kw in ({"combiner": total}, {"combiner": total, "salts": 4}, {"combiner": total, "salts": 1, "batch_size": 11}):
        m = (lambda _, vs: [p for v in vs for p in mapper(None, v)]) if "batch_size" in kw else mapper
        assert sorted(map(tuple, map_reduce(df, m, total, S, L, "k string, n bigint", **kw).collect())) == plain
    with pytest.raises(ValueError):
        map_reduce(df, mapper, total, S, L, "k string, n bigint", salts=3)


def test_null_and_nan_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (1.5,), (math.nan,), (math.nan,), (None,)], "value double")
    got = map_reduce(df, lambda _, v: [(v, 1)], total, D, L, "k double, n bigint").collect()
    assert sorted((str(r.k), r.n) for r in got) == [("1.5", 1), ("None", 2), ("nan", 2)]
    assert map_reduce(df.where("false"), lambda _, v: [(v, 1)], total, D, L, "k double, n bigint").collect() == []
    assert map_reduce(df, lambda _, v: [], total, D, L, "k double, n bigint", combiner=total).collect() == []
