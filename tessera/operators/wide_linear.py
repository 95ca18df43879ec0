"""Linear models too wide for a closure (F1, F5, D5 beyond ``linear.MAX_MODEL``).

A model is a table ``block, w array<double>`` of ``linear.BLOCK`` features a block; it
never meets the driver.  Scores come from a join of rows and blocks: a row is sent
to each block (with its raw vector: the features of a block are made there), the
partial products are added by row.  Sums over rows are made for ranges of at most
``limit`` features at a time, so a task holds one range, and merged block by block.

Results equal the closure form.  Ids must be unique and not null: they name the
rows whose partial products belong together.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import linear as L
from tessera.operators.partial import _rows, add_up, matrix
from tessera.session import cut_lineage

#: tasks among which the rows of one range of features are dealt, for each shuffle partition
SALTS = 8


def blocks_of(D: int) -> int:
    return -(-D // L.BLOCK)


def zero_model(spark, D: int) -> DataFrame:
    """``block, w`` with all weights 0."""
    size = F.least(F.lit(L.BLOCK), F.lit(D) - F.col("id") * L.BLOCK).cast("int")
    return spark.range(blocks_of(D)).select(F.col("id").alias("block"), F.array_repeat(F.lit(0.0), size).alias("w"))


def score(df: DataFrame, model: DataFrame, D: int, features: str = "raw") -> DataFrame:
    """F1: ``df`` (with ``id, x``) and ``score``."""
    size = L.BLOCK

    @F.pandas_udf("double")
    def partial(xs: pd.Series, ws: pd.Series, block: pd.Series) -> pd.Series:
        out = np.zeros(len(xs))
        for k in block.unique():
            at = np.flatnonzero(block.to_numpy() == k)
            w = np.asarray(ws.iloc[at[0]], dtype=np.float64)
            step = max(1, 2_000_000 // len(w))
            for s in range(0, len(at), step):
                X = np.stack(xs.iloc[at[s:s + step]].to_numpy()).astype(np.float64)
                out[at[s:s + step]] = L.feature_block(X, int(k) * size, int(k) * size + len(w), features) @ w
        return pd.Series(out)
    sent = df.select("id", "x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks_of(D) - 1).cast("bigint"))).alias("block"))
    parts = sent.join(model, "block").select("id", partial("x", "w", "block").alias("p"))
    return df.join(parts.groupBy("id").agg(F.sum("p").alias("score")), "id")


def vector_sum(df: DataFrame, D: int, features: str = "raw", coef: str | None = None, limit: int = L.MAX_MODEL) -> DataFrame:
    """``block, w``: the sum of coef * transform(x), by ranges of at most ``limit`` features."""
    size, blocks = L.BLOCK, blocks_of(D)
    per = max(1, limit // size)                          # blocks of a range
    ranges = -(-blocks // per)
    c = F.col(coef).cast("double") if coef else F.lit(1.0)
    rows = df.select(F.col("x").cast("array<double>").alias("x"), c.alias("c"), F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("r"),
                     F.pmod(F.xxhash64("id"), F.lit(SALTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))).alias("salt"))

    def run(batches):
        now, acc = None, {}
        for b in batches:
            r = np.asarray(b.column(2))
            X, coefs = matrix(b.column(0)), np.asarray(b.column(1))
            for one in np.unique(r):
                if one != now:
                    yield from flush(acc)
                    now, acc = one, {}
                at = np.flatnonzero(r == one)
                for k in range(int(one) * per, min(blocks, (int(one) + 1) * per)):
                    j0, j1 = k * size, min(D, (k + 1) * size)
                    step = max(1, 2_000_000 // (j1 - j0))
                    for s in range(0, len(at), step):
                        v = coefs[at[s:s + step]] @ L.feature_block(X[at[s:s + step]], j0, j1, features)
                        acc[k] = acc[k] + v if k in acc else v
        yield from flush(acc)

    def flush(acc):
        for k in sorted(acc):
            yield _rows([(k, acc[k])], pa.int64())
    parts = (rows.repartition("r", "salt").sortWithinPartitions("r").select("x", "c", "r")
             .mapInArrow(run, "task int, key bigint, sums array<double>"))
    return add_up(parts).select(F.col("key").alias("block"), F.col("sums").alias("w"))


def norm(model: DataFrame) -> float:
    return math.sqrt(model.agg(F.sum(F.aggregate("w", F.lit(0.0), lambda a, v: a + v * v))).first()[0] or 0.0)


def pegasos(train: DataFrame, lam: float, steps: int, features: str = "raw", limit: int = L.MAX_MODEL) -> DataFrame:
    """F5 with the model as a table: full-batch Pegasos, L2 projection -> ``block, w``."""
    spark = train.sparkSession
    data = train.select("id", "y", "x").persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    first = data.select("x").first()
    D = L.feature_width(len(first["x"]) if first else 0, features)
    model = zero_model(spark, D)
    for t in range(1, steps + 1):
        eta = 1.0 / (lam * t)
        viol = score(data, model, D, features).where(F.col("y") * F.col("score") < 1)
        grad = vector_sum(viol, D, features, "y", limit).withColumnRenamed("w", "g")
        old = F.transform("w", lambda v: v * F.lit(1 - eta * lam))
        step = F.when(F.col("g").isNull(), old).otherwise(F.zip_with(old, "g", lambda v, g: v + g * F.lit(eta / max(n, 1))))
        # one row for each block; the checkpoint keeps lineage one step deep
        model = cut_lineage(model.join(grad, "block", "left").select("block", step.alias("w")))
        size = norm(model)
        if size > 0:
            factor = min(1.0, 1.0 / math.sqrt(lam) / size)
            model = model.select("block", F.transform("w", lambda v: v * F.lit(factor)).alias("w"))
    data.unpersist()
    return model


def long_form(model: DataFrame) -> DataFrame:
    """``j, w`` of a model of blocks."""
    return model.select("block", F.posexplode("w").alias("at", "w")).select((F.col("block") * L.BLOCK + F.col("at")).alias("j"), "w")
