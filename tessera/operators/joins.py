"""Skew-safe bucket joins.

A bucket (an equal LSH band key, an equal prefix token, an equal grid
cell) may hold a large share of all rows.  The pairs inside a bucket are the
job's real output candidates, so they cannot be capped; instead a bucket of
``n`` rows is cut into ``s = ceil(n / block)`` blocks and every pair of blocks
becomes its own join key.  Each task then sees at most ``block x block``
pairs, and a hot bucket spreads over ``s(s+1)/2`` tasks.  Buckets below the
block size (the normal case) are not replicated at all.

Only the buckets above the block size are looked up, and there are at most
rows / block of them: their table is counted, and broadcast up to ``HOT_ROWS``,
so rows are cut into tiles before they are shuffled by key.  Beyond that it is
an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize, materialize_sets

DEFAULT_BLOCK = 4096
HOT_ROWS = 100_000


def _hot(rows: DataFrame, keys: list[str], block: int, name: str) -> DataFrame:
    """Buckets above the block size and their number of blocks."""
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    return n.select(*keys, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias(name))


def _look_up(rows: DataFrame, hot: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``rows`` with the block counts of their bucket, 1 where it is not hot."""
    hot = materialize(hot)
    n = hot.count()
    if n == 0:
        return rows.withColumns({x: F.lit(1) for x in names})
    j = rows.join(F.broadcast(hot) if n <= HOT_ROWS else hot, keys, "left")
    return j.withColumns({x: F.coalesce(x, F.lit(1)) for x in names})


def _block(id_col: str, count: str):
    return F.pmod(F.xxhash64(F.col(id_col)), F.col(count)).cast("int")


def _with_blocks(rows: DataFrame, keys: list[str], id_col: str, block: int) -> DataFrame:
    return _look_up(rows, _hot(rows, keys, block, "_s"), keys, ["_s"]).withColumn("_b", _block(id_col, "_s"))


def bucket_self_pairs(rows: DataFrame, keys: list[str], id_col: str,
                      block: int = DEFAULT_BLOCK, extra: list[str] | None = None) -> DataFrame:
    """All unordered pairs (a < b) of ids sharing a bucket.

    Returns ``a, b`` plus ``a_<c>, b_<c>`` for every column in ``extra``.
    Pairs sharing several buckets appear once per shared bucket; callers
    deduplicate after their own pair filters.
    """
    extra = extra or []
    # the narrow input feeds the size count and both join sides: fill it once; its keys may be computed of sets
    r = _with_blocks(materialize_sets(rows.select(*keys, id_col, *extra)), keys, id_col, block)
    left = (r.withColumn("_tj", F.explode(F.sequence(F.col("_b"), F.col("_s") - 1)))
            .withColumn("_ti", F.col("_b")))
    right = (r.withColumn("_ti", F.explode(F.sequence(F.lit(0), F.col("_b"))))
             .withColumn("_tj", F.col("_b")))
    jk = keys + ["_ti", "_tj"]
    l = left.select(*jk, F.col(id_col).alias("_l"), *[F.col(c).alias("_l_" + c) for c in extra])
    rr = right.select(*jk, F.col(id_col).alias("_r"), *[F.col(c).alias("_r_" + c) for c in extra])
    j = l.join(rr, jk).where((F.col("_ti") < F.col("_tj")) | (F.col("_l") < F.col("_r")))
    j = j.where(F.col("_l") != F.col("_r"))
    swap = F.col("_l") > F.col("_r")
    cols = [F.least("_l", "_r").alias("a"), F.greatest("_l", "_r").alias("b")]
    for c in extra:
        cols.append(F.when(swap, F.col("_r_" + c)).otherwise(F.col("_l_" + c)).alias("a_" + c))
        cols.append(F.when(swap, F.col("_l_" + c)).otherwise(F.col("_r_" + c)).alias("b_" + c))
    return j.select(*cols)


def bucket_cross_pairs(left: DataFrame, right: DataFrame, keys: list[str],
                       left_id: str, right_id: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """All (left_id, right_id) pairs sharing a bucket, tiled for skew."""
    left, right = materialize(left.select(*keys, left_id)), materialize(right.select(*keys, right_id))
    hot = _hot(left, keys, block, "_sl").join(_hot(right, keys, block, "_sr"), keys, "full")
    l = (_look_up(left, hot, keys, ["_sl", "_sr"]).withColumn("_ti", _block(left_id, "_sl"))
         .withColumn("_tj", F.explode(F.sequence(F.lit(0), F.col("_sr") - 1))))
    r = (_look_up(right, hot, keys, ["_sl", "_sr"]).withColumn("_tj", _block(right_id, "_sr"))
         .withColumn("_ti", F.explode(F.sequence(F.lit(0), F.col("_sl") - 1))))
    jk = keys + ["_ti", "_tj"]
    return (l.select(*jk, left_id).join(r.select(*jk, right_id), jk)
            .select(left_id, right_id))
