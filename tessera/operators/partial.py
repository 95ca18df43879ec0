"""Sums of many numbers by key, added up in the tasks.

A task adds its rows into one array for each key it has seen and sends these; the
tasks' arrays are added in two steps, first in lots of tasks, then by key, so what
a task holds is the size of the result however many tasks there are.  The second
step of a small result is taken by the driver.  Arrays are added in the order of
the tasks: the same partitions give the same bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lots in which the tasks' arrays are first added.
LOTS = 64
#: Results of up to so many numbers are added up by the driver (at most LOTS times 1 MB reach it).
DRIVER_CELLS = 1 << 17


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equally long lists as n x d doubles."""
    n = len(col)
    flat = np.asarray(col.flatten(), dtype=np.float64)
    return flat.reshape(n, len(flat) // n if n else 0)


def _rows(sums: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([task] * len(sums), pa.int32()), pa.array([k for k, _ in sums], key_type),
         pa.array([v for _, v in sums], pa.list_(pa.float64()))], names=["task", "key", "sums"])


def _add(acc: dict, key, v: np.ndarray) -> None:
    acc[key] = acc[key] + v if key in acc else v


def add_up(parts: DataFrame, key_type: str = "bigint", lots_only: bool = False) -> DataFrame:
    """``task, key, sums`` rows -> one row for each key (for each key and lot of tasks if
    ``lots_only``).  Rows come sorted by key, so a task holds one key's array."""
    kind = pa.string() if key_type == "string" else pa.int64()

    def merge(batches):
        now, total, some = None, None, False
        for b in batches:
            off, flat = np.asarray(b.column("sums").offsets), np.asarray(b.column("sums").values)
            done = []
            for i, key in enumerate(b.column("key").to_pylist()):
                v = flat[off[i]:off[i + 1]]
                if some and key == now:
                    total = total + v
                else:
                    if some:
                        done.append((now, total))
                    now, total, some = key, v.copy(), True
            if done:
                yield _rows(done, kind)
        if some:
            yield _rows([(now, total)], kind)

    schema = f"task int, key {key_type}, sums array<double>"
    lots = parts.repartition("key", F.col("task") % LOTS).sortWithinPartitions("key", "task").mapInArrow(merge, schema)
    if lots_only:
        return lots
    return lots.repartition("key").sortWithinPartitions("key", "task").mapInArrow(merge, schema)


def _parts(df: DataFrame, part: Callable[[pa.RecordBatch], Iterable[tuple[object, np.ndarray]]], key_type: str) -> DataFrame:
    """``task, key, sums``: the arrays that ``part`` gives for a task's batches, added by key."""
    kind = pa.string() if key_type == "string" else pa.int64()

    def run(batches):
        acc: dict = {}
        for b in batches:
            if b.num_rows:
                for key, v in part(b):
                    _add(acc, key, v)
        for k in sorted(acc, key=lambda k: (k is not None, k)):
            yield _rows([(k, acc.pop(k))], kind)
    return df.mapInArrow(run, f"task int, key {key_type}, sums array<double>")


def sums_by_key(df: DataFrame, part, key_type: str = "bigint") -> DataFrame:
    """``key, sums``: the sum of the arrays that ``part`` gives for the batches of ``df``.

    ``part`` returns (key, array) pairs; one key's arrays have one length.
    """
    return add_up(_parts(df, part, key_type), key_type).select("key", "sums")


def collect_sums(df: DataFrame, part, cells: int, key_type: str = "bigint") -> dict:
    """{key: sum} of :func:`sums_by_key` for a result of about ``cells`` numbers."""
    if cells > DRIVER_CELLS:
        return {r["key"]: np.array(r["sums"]) for r in sums_by_key(df, part, key_type).collect()}
    acc: dict = {}
    for r in sorted(add_up(_parts(df, part, key_type), key_type, lots_only=True).collect(), key=lambda r: r["task"]):
        _add(acc, r["key"], np.array(r["sums"]))
    return acc


def grouped(keys: np.ndarray, values: np.ndarray) -> Iterable[tuple[int, np.ndarray]]:
    """(key, column sums) of the rows of a matrix."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return zip(keys[at].tolist(), np.add.reduceat(values, at, axis=0))


def weighted_rows(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows ``w, w x`` whose sums give a weighted mean."""
    return np.column_stack([w, x * w[:, None]])


def mean_by_key(df: DataFrame, key: str, x: str = "x", weight: str | None = None, cells: int = DRIVER_CELLS + 1) -> list[tuple[int, float, np.ndarray]]:
    """(key, sum of weights, weighted mean) of vectors by an integer key, in order of the
    keys; the result must be model-sized (``cells`` numbers, if known).  Rows without a
    key or vector take no part."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.col(x).alias("x"), w.alias("w")).where("k IS NOT NULL AND x IS NOT NULL")

    def part(b):
        return grouped(np.asarray(b.column(0)), weighted_rows(matrix(b.column(1)), np.asarray(b.column(2))))
    return means_of(collect_sums(rows, part, cells))


def means_of(sums: dict) -> list[tuple[int, float, np.ndarray]]:
    """(key, weight, mean) of sums of :func:`weighted_rows`."""
    return [(k, float(v[0]), v[1:] / v[0]) for k, v in sorted(sums.items()) if v[0]]


def moments(df: DataFrame, x: str = "x") -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, covariance) of vectors (population covariance): one pass of n, x and x x^T,
    taken about the first vector so that large offsets cost no digits."""
    first = df.where(F.col(x).isNotNull()).select(x).first()
    if first is None:
        return 0, np.zeros(0), np.zeros((0, 0))
    origin = np.array(first[0], dtype=np.float64)
    d = len(origin)

    def part(b):
        v = matrix(b.column(0)) - origin
        yield 0, np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
    s = collect_sums(df.select(x).where(F.col(x).isNotNull()), part, d * d + d)[0]
    n, m = int(s[0]), s[1:d + 1] / s[0]
    return n, origin + m, s[d + 1:].reshape(d, d) / n - np.outer(m, m)
