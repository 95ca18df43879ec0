"""Reproducible sampling and ordering operators.

Randomness is ``md5(seed:tag:id)`` so a retried task (or another engine)
draws the same numbers; ``rand()`` is never used.
"""

from __future__ import annotations

import sys
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import uniform


def race_key(id_col: str, weight: Column, seed: int, tag: str = "race") -> Column:
    """Efraimidis-Spirakis exponential race key -ln(u)/w (smaller wins)."""
    return F.least(-F.log(uniform(seed, tag, F.col(id_col))) / weight, F.lit(sys.float_info.max))


#: Up to so many rows are chosen by one ordered limit; above, by a threshold.
TOP_ROWS = 4_096
#: Ranges of one histogram pass.
BUCKETS = 4_096


def _cut(rows: DataFrame, col: str, n: int) -> tuple[float | int, int, int]:
    """The value of ``col`` at rank n, the number of rows below it and of rows equal to it.

    Each pass counts the rows of ``BUCKETS`` equal ranges between two bounds and goes
    on in the range that holds rank n, between that range's own least and largest
    value, until these are equal.  A pass returns at most ``BUCKETS`` rows.
    """
    c = F.col(col)
    whole = isinstance(rows.schema[col].dataType, T.LongType)
    lo, hi, size = rows.agg(F.min(c), F.max(c), F.count(c)).first()
    below = 0
    while lo != hi:
        if whole:
            at = F.floor((c.cast("decimal(20,0)") - F.lit(lo)) * F.lit(BUCKETS) / F.lit(Decimal(hi - lo + 1)))
        else:
            width = hi / BUCKETS - lo / BUCKETS
            at = F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)) if width > 0 else (c > F.lit(lo)).cast("int")
        ranges = rows.where(c.between(lo, hi)).groupBy(at.alias("at")).agg(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).collect()
        for r in sorted(ranges, key=lambda r: r["lo"]):
            if below + r["n"] >= n:
                lo, hi, size = r["lo"], r["hi"], r["n"]
                break
            below += r["n"]
    return lo, below, size


def smallest(rows: DataFrame, key: str, id_col: str, n: int) -> tuple[DataFrame, float | None]:
    """The n rows with the smallest ``(key, id)``, and the key of the row after them (None
    if there is none).

    Up to ``TOP_ROWS`` rows are an ordered limit.  Beyond, rank n's key is found by
    histograms of the keys and, among equal keys, its id by histograms of the ids;
    rows up to there are a filter, so neither the driver nor a task sees n rows.  Of
    rows with one key and one id a limit takes as many as are wanted.  Keys are
    finite doubles, ids bigints; ``rows`` is read several times.
    """
    if n <= TOP_ROWS:
        top = rows.select(key, id_col).orderBy(key, id_col).limit(n + 1).collect()
        return rows.orderBy(key, id_col).limit(n), (top[n][key] if len(top) > n else None)
    narrow = rows.select(key, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if narrow.count() <= n:
            return rows, None
        tau, below, equal = _cut(narrow, key, n)
        k, i = F.col(key), F.col(id_col)
        if below + equal == n:
            return rows.where(k <= F.lit(tau)), narrow.where(k > F.lit(tau)).agg(F.min(k)).first()[0]
        last, fewer, copies = _cut(narrow.where(k == F.lit(tau)), id_col, n - below)
        before = (k < F.lit(tau)) | ((k == F.lit(tau)) & (i < F.lit(last)))
        at = (k == F.lit(tau)) & (i == F.lit(last))
        wanted = n - below - fewer
        if wanted == copies:
            return rows.where(before | at), tau
        return rows.where(before).unionByName(rows.where(at).limit(wanted)), tau
    finally:
        narrow.unpersist()


def up_to(rows: DataFrame, key: str, id_col: str, n: int) -> Column:
    """A condition that holds for the n rows with the smallest ``(key, id)`` (and rows equal
    to the last of them); ``rows`` should be persisted."""
    tau, below, equal = _cut(rows, key, n)
    if below + equal == n:
        return F.col(key) <= F.lit(tau)
    last, _, _ = _cut(rows.where(F.col(key) == F.lit(tau)), id_col, n - below)
    return (F.col(key) < F.lit(tau)) | ((F.col(key) == F.lit(tau)) & (F.col(id_col) <= F.lit(last)))


def weighted_sample(df: DataFrame, weight: str | Column, n: int, seed: int, id_col: str = "id",
                    compat: bool = False, tag: str = "race") -> DataFrame:
    """Draw n rows without replacement with probability proportional to ``weight``.

    The n smallest race keys win (:func:`smallest`); the drawn rows stay distributed.
    Output adds ``p`` (normalised probability) and ``weight``:
    ``compat=True`` gives the reference's 1/p; otherwise the unbiased
    bottom-k weight 1/(1-exp(-w*tau)) with tau the (n+1)-th smallest key
    (1.0 when fewer than n+1 rows are eligible).  Rows with weight <= 0, and rows
    without an id, to which no draw belongs, are never drawn.  ``sum(weight)``
    estimates the row count.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    e = df.withColumn("_w", w.cast("double")).where((F.col("_w") > 0) & F.col(id_col).isNotNull())
    total = e.agg(F.sum("_w")).first()[0] or 0.0
    keyed = e.withColumn("_key", race_key(id_col, F.col("_w"), seed, tag))
    chosen, tau = smallest(keyed, "_key", id_col, n)
    p = F.col("_w") / F.lit(total)
    if compat:
        wt = F.lit(1.0) / p
    elif tau is None:
        wt = F.lit(1.0)
    else:
        wt = F.lit(1.0) / (F.lit(1.0) - F.exp(-F.col("_w") * F.lit(float(tau))))
    return chosen.withColumn("p", p).withColumn("weight", wt).drop("_w", "_key")


def uniform_sample(df: DataFrame, n: int, seed: int, id_col: str = "id", compat: bool = False) -> DataFrame:
    """N rows uniformly without replacement (E2 with a constant weight)."""
    return weighted_sample(df, F.lit(1.0), n, seed, id_col, compat, tag="uni")


def batch_assign(df: DataFrame, batch_size: int, id_col: str = "id") -> DataFrame:
    """E5: fixed-size batches by id: ``batch = floor(id / batch_size)``.

    Dense ids are assumed (no global sort is needed); for sparse ids use
    :func:`hash_batches`.
    """
    return df.withColumn("batch", F.floor(F.col(id_col) / F.lit(batch_size)).cast("bigint"))


def hash_batches(df: DataFrame, n_batches: int, seed: int, id_col: str = "id") -> DataFrame:
    return df.withColumn("batch", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(n_batches)))


def shuffle_order(df: DataFrame, seed: int, id_col: str = "id", by: str = "batch") -> DataFrame:
    """Seeded permutation rank within each batch (``pos`` from 1)."""
    from pyspark.sql import Window
    w = Window.partitionBy(by).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))),
                                       F.col(id_col))
    return df.withColumn("pos", F.row_number().over(w))
