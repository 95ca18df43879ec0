"""Active learning over a large pool (F8): uncertainty sampling with its options.

A round takes points near the decision boundary and asks for their labels.  Three
options keep that cheap and honest on a large pool: a hyperplane hash index (L7),
built once and kept across rounds, so a round scores only points that collide with
the current hyperplane; a random subsample of the pool; and a share of uniform picks.
Labels come from a table, which need not know every point.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import gaussian_matrix, uniform
from tessera.operators import linear as L
from tessera.operators.sampling import race_key
from tessera.session import cut_lineage

BITS = "u bigint, v bigint"
#: labelled rows of a partition
ROWS = 4_096


class HyperplaneIndex:
    """A pool ``id, x`` with the packed sign bits ``u, v`` of its 2-bit hashes, persisted: a
    round compares two integers a point and projects nothing."""

    def __init__(self, pool: DataFrame, d: int, tables: int, seed: int):
        if not 0 < tables <= 62:
            raise ValueError("1 to 62 tables")
        self.tables = tables
        self.U, self.V = gaussian_matrix(tables, d, seed, "hu"), gaussian_matrix(tables, d, seed, "hv")
        U, V, weigh = self.U, self.V, 1 << np.arange(tables, dtype=np.int64)

        @F.pandas_udf(BITS)
        def bits(xs: pd.Series) -> pd.DataFrame:
            X = np.stack(xs.to_numpy()).astype(np.float64) if len(xs) else np.zeros((0, d))
            return pd.DataFrame({"u": (X @ U.T >= 0) @ weigh, "v": (X @ V.T >= 0) @ weigh})
        b = pool.where(F.col("x").isNotNull()).withColumn("_b", bits("x"))
        self.rows = b.select("id", "x", F.col("_b.u").alias("u"), F.col("_b.v").alias("v")).persist(StorageLevel.MEMORY_AND_DISK)

    def near(self, w: np.ndarray) -> Column:
        """Whether a row collides with the hyperplane w in any table:
        [sgn(u.x), sgn(v.x)] = [sgn(u.w), -sgn(v.w)]."""
        pack = lambda b: int(sum(1 << t for t in range(self.tables) if b[t]))
        same_u = F.bitwise_not(F.col("u").bitwiseXOR(F.lit(pack(self.U @ w >= 0)).cast("bigint")))
        same_v = F.bitwise_not(F.col("v").bitwiseXOR(F.lit(pack(self.V @ w < 0)).cast("bigint")))
        return same_u.bitwiseAND(same_v).bitwiseAND(F.lit((1 << self.tables) - 1).cast("bigint")) != 0


def together(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` labelled rows in few partitions: each training step is a job over them, and
    rows left in the partitions of the joins they come from cost a task for each of these."""
    return rows.repartition(max(1, math.ceil(n / ROWS)))


def active_round(index: HyperplaneIndex, labeled: DataFrame, labels: DataFrame, w: np.ndarray, m: int, lam: float, steps: int,
                 seed: int, number: int = 0, prefilter: bool = False, explore: float = 0.0, subsample: float = 1.0) -> tuple[DataFrame, np.ndarray, dict]:
    """One round: (labelled rows ``id, y, x``, new model, counts).

    ``m`` points are asked for: a share ``explore`` uniformly from the pool, the rest the
    most uncertain of a random ``subsample``, and with ``prefilter`` only of those that
    collide with the hyperplane in the index (of all of the subsample where these are too
    few).  Points whose label the table does not know stay unlabelled.  ``number`` is
    the round's, so that rounds draw differently.
    """
    pool = index.rows.join(labeled.select("id"), "id", "left_anti")
    uniform_m = min(m, math.ceil(explore * m))
    drawn = pool.where(uniform(seed, f"al:sub:{number}", F.col("id")) < subsample) if subsample < 1 else pool
    cand = drawn.where(index.near(w)) if prefilter else drawn
    n_cand = cand.count() if prefilter else None
    if prefilter and n_cand < m - uniform_m:
        cand = drawn
    scored = cand.withColumn("score", L.score_udf(w, len(w))(F.col("x")))
    sure = L.uncertainty_topm(scored, m - uniform_m).select("id", "x")
    any_key = race_key("id", F.lit(1.0), seed, f"al:any:{number}")
    # m rows more than needed: those already taken as uncertain are left out
    some = (pool.withColumn("_k", any_key).orderBy("_k", "id").limit(uniform_m + m).join(sure.select("id"), "id", "left_anti")
            .orderBy("_k", "id").limit(uniform_m).select("id", "x"))
    asked = sure.unionByName(some).persist(StorageLevel.MEMORY_AND_DISK)
    new = asked.join(labels.select("id", "y").where("y IS NOT NULL").dropDuplicates(["id"]), "id").select("id", "y", "x")
    new = together(new, m)
    # the next round names these rows several times: their plan must not hold this round's
    out = cut_lineage(labeled.select("id", "y", "x").unionByName(new))
    counts = {"round": number, "candidates": n_cand, "asked": asked.count(), "labeled": out.count()}
    asked.unpersist()
    return out, L.pegasos(out, lam, steps), counts
