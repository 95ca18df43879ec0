"""Greedy submodular selection.

Every round is a distributed aggregation that returns one winner (a
TakeOrdered of one row) to the driver; the residual tables are persisted
and their lineage cut with reliable checkpoints every few rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, swap

MAX_BROADCAST_ELEMS = 2_000_000


def _residual_after(rem: DataFrame, chosen_elems: DataFrame) -> DataFrame:
    n = chosen_elems.count()
    ce = F.broadcast(chosen_elems) if n <= MAX_BROADCAST_ELEMS else chosen_elems
    return rem.join(ce, "elem", "left_anti")


def greedy_cover(elements: DataFrame, k: int, checkpoint_every: int = 4, repeats: bool = False) -> DataFrame:
    """Pick k sets maximising the number of covered elements (F = |union|).

    ``elements``: ``set_id, elem`` in distinct pairs; with ``repeats`` pairs may occur
    again, which costs a shuffle to mend.  Each round counts the
    uncovered elements per set (partial aggregation), takes the best set
    (gain desc, id asc) and removes its elements from the residual table
    with an anti join.  Output ``round, set_id, gain``; stops early when no
    set adds anything.
    """
    rem = elements.select("set_id", "elem")
    rem = (rem.distinct() if repeats else rem).persist(StorageLevel.MEMORY_AND_DISK)
    out = []
    for r in range(1, k + 1):
        best = (rem.groupBy("set_id").agg(F.count(F.lit(1)).alias("gain"))
                .orderBy(F.col("gain").desc(), "set_id").limit(1).collect())
        if not best or best[0]["gain"] == 0:
            break
        sid, gain = best[0]["set_id"], int(best[0]["gain"])
        out.append((r, sid, gain))
        chosen = rem.where(F.col("set_id") == sid).select("elem")
        rem = swap(rem, _residual_after(rem, chosen), checkpoint=r % checkpoint_every == 0)
    return elements.sparkSession.createDataFrame(out, "round int, set_id bigint, gain bigint")


def lazy_greedy_cover(elements: DataFrame, k: int, m0: int = 8, checkpoint_every: int = 4, repeats: bool = False) -> DataFrame:
    """The same result as :func:`greedy_cover`, evaluating few sets per round.

    Stale gains are upper bounds (gains only shrink).  Each round evaluates
    the true gain of the top-M sets by bound; the best is accepted when its
    gain beats the (M+1)-th bound, otherwise M doubles.  Evaluated sets get
    their true gain as the new bound.
    """
    spark = elements.sparkSession
    rem = elements.select("set_id", "elem")
    rem = (rem.distinct() if repeats else rem).persist(StorageLevel.MEMORY_AND_DISK)
    bounds = rem.groupBy("set_id").agg(F.count(F.lit(1)).cast("double").alias("bound")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    out = []
    for r in range(1, k + 1):
        m = m0
        while True:
            top = bounds.orderBy(F.col("bound").desc(), "set_id").limit(m + 1).collect()
            if not top:
                break
            cand = [row["set_id"] for row in top[:m]]
            nxt_bound = top[m]["bound"] if len(top) > m else -1.0
            ids = spark.createDataFrame([(c,) for c in cand], "set_id bigint")
            gains = (rem.join(F.broadcast(ids), "set_id").groupBy("set_id")
                     .agg(F.count(F.lit(1)).alias("gain")).collect())
            g = {row["set_id"]: int(row["gain"]) for row in gains}
            best_id = min(cand, key=lambda c: (-g.get(c, 0), c))
            best_gain = g.get(best_id, 0)
            upd = spark.createDataFrame([(c, float(g.get(c, 0))) for c in cand], "set_id bigint, newb double")
            bounds = swap(bounds, bounds.join(F.broadcast(upd), "set_id", "left")
                          .select("set_id", F.coalesce("newb", "bound").alias("bound")))
            if best_gain > nxt_bound or len(top) <= m:
                break
            m *= 2
        if not top or best_gain == 0:
            break
        out.append((r, best_id, best_gain))
        chosen = rem.where(F.col("set_id") == best_id).select("elem")
        rem = swap(rem, _residual_after(rem, chosen), checkpoint=r % checkpoint_every == 0)
        if r % checkpoint_every == 0:
            bounds = swap(bounds, bounds, checkpoint=True)
    return spark.createDataFrame(out, "round int, set_id bigint, gain bigint")


def facility_location(points: DataFrame, facilities: np.ndarray, fac_ids: list[int], k: int,
                      checkpoint_every: int = 4) -> DataFrame:
    """Greedy max of F(A) = sum_i max_{j in A} M_ij with M_ij = 1 + x_i . f_j
    over a bounded candidate facility set (literal, model-sized).

    Each round: per task, gains_j = sum_i max(0, M_ij - cur_i) by one NumPy
    block, summed by ``groupBy(j)``; the winner's column updates cur_i.
    """
    Fm = np.asarray(facilities, dtype=np.float64)
    cur = points.select("id", "x", F.lit(0.0).alias("cur")).persist(StorageLevel.MEMORY_AND_DISK)
    out = []
    chosen: list[int] = []
    for r in range(1, k + 1):
        def _gains(batches, Fm=Fm):
            acc = np.zeros(Fm.shape[0])
            for pdf in batches:
                if not len(pdf):
                    continue
                X = np.stack(pdf["x"].to_numpy()).astype(np.float64)
                M = 1.0 + X @ Fm.T
                acc += np.maximum(0.0, M - pdf["cur"].to_numpy()[:, None]).sum(axis=0)
            yield pd.DataFrame({"j": np.arange(Fm.shape[0], dtype=np.int32), "g": acc})

        g = cur.mapInPandas(_gains, "j int, g double").groupBy("j").agg(F.sum("g").alias("g")).collect()
        gains = {row["j"]: row["g"] for row in g}
        cand = [j for j in range(Fm.shape[0]) if j not in chosen]
        if not cand:
            break
        best = min(cand, key=lambda j: (-gains.get(j, 0.0), fac_ids[j]))
        chosen.append(best)
        out.append((r, int(fac_ids[best]), float(gains.get(best, 0.0))))
        f = [float(v) for v in Fm[best]]
        from tessera.functions.vectors import dot
        nxt = cur.select("id", "x", F.greatest("cur", F.lit(1.0) + dot("x", f)).alias("cur"))
        cur = swap(cur, nxt, checkpoint=r % checkpoint_every == 0)
    return points.sparkSession.createDataFrame(out, "round int, facility bigint, gain double")
