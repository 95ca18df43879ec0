"""Input parallelism guard.

A compute-heavy per-row stage (tokenising, MinHash) runs one task per input
partition.  A small or unsplittable input (one Parquet row group) gives a
single partition and leaves the cluster idle; in that case only, rows are
spread round-robin over the default parallelism.  Inputs that already have
at least that many partitions (any large table) are left untouched, so no
extra shuffle is added at scale.

A file is split by bytes, but a Parquet row group is read whole by one task: of
the partitions of a file with few row groups most are empty.  :func:`spread_rows`
looks at the rows of the partitions, not only at how many partitions there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def spread_rows(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, row by row out of the table ``source``, with its rows over at least the
    default parallelism.

    The rows of ``source`` are counted by partition, for which a scan reads only the
    files' footers; they stay where they are unless a partition has over twice its share.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    now = df.rdd.getNumPartitions()
    if now >= target:
        n, most = (source.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
                   .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first())
        if most * target <= 2 * n:
            return df
    return df.repartition(max(target, now))


def by_key(df: DataFrame, *keys: str, factor: int = 2) -> DataFrame:
    """Hash-partition on the grouping keys before a Python-heavy grouped map.

    AQE would coalesce a small shuffle into a few partitions and serialize
    the (CPU-bound) groups; an explicit repartition keeps one task slot per
    core busy, and the following ``groupBy(keys)`` reuses this partitioning
    (no second shuffle).
    """
    n = df.sparkSession.sparkContext.defaultParallelism * factor
    return df.repartition(n, *keys)
