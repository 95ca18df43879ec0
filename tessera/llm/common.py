"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that one NumPy step works on; longer batches are cut between rows.
STEP_BYTES = 2 << 20


def keep(df: DataFrame) -> DataFrame:
    """Persist for several readers; lost blocks come back from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def byte_rows(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte buffer and n+1 row offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if big else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(off: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def minimum_forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels 0..n-1 of the components of the edges (i, j): the smallest member."""
    lab = np.arange(n)
    while len(i):
        m = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, lab[i], m)
        np.minimum.at(new, lab[j], m)
        while True:
            nxt = new[new]
            if np.array_equal(nxt, new):
                break
            new = nxt
        lab = new[lab]
        far = lab[i] != lab[j]
        i, j = i[far], j[far]
    return lab


def members(comp: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with ``component``: its own key where ``comp`` has no row."""
    c = comp.select(F.col("node").alias(key), "component")
    return keys.join(c, key, "left").withColumn("component", F.coalesce("component", key))


def one_text_per_id(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text`` (null as empty) in two parts: rows that stand for their id, and
    rows aside: those without an id, and of different texts under one id all but the
    one with the smallest hash."""
    every = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named, aside = every.where("doc_id IS NOT NULL"), every.where("doc_id IS NULL")
    mark = F.xxhash64("text")
    twice = keep(named.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select("doc_id", "low"))
    if twice.limit(1).count():
        j = named.join(twice, "doc_id", "left")
        other = F.coalesce(mark != F.col("low"), F.lit(False))
        aside = aside.unionByName(j.where(other).select("doc_id", "text"))
        named = j.where(~other).select("doc_id", "text")
    return named, aside
