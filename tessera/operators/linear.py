"""Linear classification.

Rows are ``id, y (+1/-1), x array<double>``.  A model is a dense weight
vector of D numbers (D = d for raw features, d^2 for ``poly2``): up to ``MAX_MODEL``
numbers it lives on the driver and is shipped to tasks inside Arrow-batched
functions; larger ones are tables of blocks (:mod:`tessera.operators.wide_linear`).
Every pass over the data is distributed; the only things returned to the driver
are model-sized (a task adds its rows up and sends arrays of a block each, see
:mod:`tessera.operators.partial`).
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.features import poly2_weights_matrix
from tessera.operators.partial import add_up, collect_sums, matrix
from tessera.operators.sampling import hash_batches
from tessera.session import checkpoint_dir
from tessera.sources.parallel import by_key

MAX_MODEL = 50_000_000  # doubles


def feature_width(d: int, features: str) -> int:
    return d * d if features == "poly2" else d


# ------------------------------------------------------------------ scoring
def score_udf(w: np.ndarray, d: int, features: str = "raw"):
    """F1/H4: Arrow-batched <w, transform(x)>; poly2 scores as x^T M x (no d^2 row)."""
    if w.shape[0] != feature_width(d, features):
        raise ValueError(f"weights have {w.shape[0]} entries, features give {feature_width(d, features)}")
    M = poly2_weights_matrix(w, d) if features == "poly2" else None

    @F.pandas_udf(T.DoubleType())
    def _score(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=float)
        X = np.stack(xs.to_numpy()).astype(np.float64)
        if M is not None:
            s = ((X @ M) * X).sum(1)
        else:
            s = X @ w
        return pd.Series(s)

    return _score


def svm_score(df: DataFrame, w: np.ndarray, features: str = "raw", x_col: str = "x") -> DataFrame:
    d = len(df.select(x_col).first()[0])
    return df.withColumn("score", score_udf(w, d, features)(F.col(x_col)))


def margin_violators(scored: DataFrame) -> DataFrame:
    """B2: rows with y * score < 1 (strict)."""
    return scored.where(F.col("y") * F.col("score") < 1)


def svm_accuracy(scored: DataFrame) -> DataFrame:
    """Share of rows with y * score > 0 (a zero score counts as wrong)."""
    return scored.agg(F.avg(F.when(F.col("y") * F.col("score") > 0, 1.0).otherwise(0.0)).alias("accuracy"),
                      F.count(F.lit(1)).alias("n"))


def svm_objective(scored: DataFrame, w: np.ndarray, lam: float) -> DataFrame:
    """lambda/2 ||w||^2 + mean hinge loss."""
    reg = 0.5 * lam * float(w @ w)
    return scored.agg((F.lit(reg) + F.avg(F.greatest(F.lit(0.0), 1 - F.col("y") * F.col("score"))))
                      .alias("objective"), F.avg(F.greatest(F.lit(0.0), 1 - F.col("y") * F.col("score")))
                      .alias("mean_hinge"))


def multiclass_hinge(df: DataFrame, W: np.ndarray, label_col: str = "label", x_col: str = "x") -> DataFrame:
    """max_{r != y} [1 - (Wx)_y + (Wx)_r]_+ per row (W literal, C x d)."""
    from tessera.functions.vectors import mat_vec_rows
    s = mat_vec_rows(W.tolist(), F.col(x_col))
    C = W.shape[0]
    sy = F.element_at(F.col("_s"), F.col(label_col) + 1)
    others = F.filter(F.sequence(F.lit(0), F.lit(C - 1)), lambda r: r != F.col(label_col))
    loss = F.array_max(F.transform(others, lambda r: F.greatest(
        F.lit(0.0), F.lit(1.0) - sy + F.element_at(F.col("_s"), r + 1))))
    return df.withColumn("_s", s).withColumn("loss", loss).drop("_s")


def uncertainty_topm(scored: DataFrame, m: int, id_col: str = "id") -> DataFrame:
    """The m rows with the smallest |score| (id tie-break); a TakeOrdered."""
    return scored.orderBy(F.abs("score"), id_col).limit(m)


# ------------------------------------------------------------------ sums
#: features of a model block
BLOCK = 1 << 16


def feature_block(X: np.ndarray, j0: int, j1: int, features: str) -> np.ndarray:
    """Features j0..j1-1 of a batch of rows (n x (j1 - j0))."""
    if features == "raw":
        return X[:, j0:j1]
    if features != "poly2":
        raise ValueError(features)
    i, k = np.divmod(np.arange(j0, j1), X.shape[1])
    return X[:, i] * X[:, k] * np.where(i == k, 1.0, math.sqrt(2.0))


def _block_sums(X: np.ndarray, c: np.ndarray, features: str, D: int, block: int):
    """(block, sums) of c * features, a block of features and some rows at a time."""
    for k, j0 in enumerate(range(0, D, block)):
        j1 = min(D, j0 + block)
        step = max(1, 2_000_000 // (j1 - j0))  # a step holds <= 2M doubles
        yield k, sum((c[s:s + step] @ feature_block(X[s:s + step], j0, j1, features) for s in range(0, len(X), step)), np.zeros(j1 - j0))


def _dense(sums: dict, D: int) -> np.ndarray:
    out = np.zeros(D)
    for k, v in sums.items():
        if k >= 0:
            out[k * BLOCK:k * BLOCK + len(v)] = v
    return out


def vector_sum(df: DataFrame, features: str = "raw", coef: str | None = None,
               x_col: str = "x") -> tuple[np.ndarray, int]:
    """Distributed sum of coef * transform(x) -> (dense D vector, row count)."""
    first = df.select(x_col).first()
    if first is None:
        return np.zeros(0), 0
    D = feature_width(len(first[0]), features)
    if D > MAX_MODEL:
        raise ValueError("model too large")
    c, block = F.col(coef).cast("double") if coef else F.lit(1.0), BLOCK

    def part(b):
        X = matrix(b.column(0))
        yield -1, np.array([float(len(X))])
        yield from _block_sums(X, np.asarray(b.column(1)), features, D, block)
    sums = collect_sums(df.select(F.col(x_col).cast("array<double>").alias("x"), c.alias("c")), part, D)
    return _dense(sums, D), int(sums[-1][0]) if -1 in sums else 0


def hinge_sums(df: DataFrame, w: np.ndarray, d: int, features: str = "raw") -> tuple[np.ndarray, int]:
    """(sum of y transform(x) over the rows whose margin the model violates, all rows) in one pass."""
    D, block = len(w), BLOCK
    M = poly2_weights_matrix(w, d) if features == "poly2" else None

    def part(b):
        X, y = matrix(b.column(0)), np.asarray(b.column(1))
        s = ((X @ M) * X).sum(1) if M is not None else X @ w
        yield -1, np.array([float(len(X))])
        at = np.flatnonzero(y * s < 1)
        if len(at):
            yield from _block_sums(X[at], y[at], features, D, block)
    sums = collect_sums(df.select(F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y")), part, D)
    return _dense(sums, D), int(sums[-1][0]) if -1 in sums else 0


def model_table(spark, w: np.ndarray) -> DataFrame:
    return spark.createDataFrame(pd.DataFrame({"j": np.arange(len(w), dtype=np.int32), "w": w}))


def model_vector(model: DataFrame, D: int) -> np.ndarray:
    if D > MAX_MODEL:
        raise ValueError("model too large")
    out = np.zeros(D)
    for r in model.select("j", "w").collect():
        out[int(r["j"])] = r["w"]
    return out


# ------------------------------------------------------------------ per-batch training
def _row_feat(features: str):
    if features == "raw":
        return lambda x: x
    d_cache = {}

    def f(x):
        d = x.shape[0]
        N = d_cache.get(d)
        if N is None:
            N = np.full((d, d), math.sqrt(2.0))
            np.fill_diagonal(N, 1.0)
            d_cache[d] = N
        return (np.outer(x, x) * N).ravel()
    return f


class AdamRule:
    """Adam on the hinge gradient: both moments follow every row, the weights move
    only when the row's margin is violated."""

    def __init__(self, lam: float, beta1: float, beta2: float, eps: float = 1e-6):
        self.lam, self.beta1, self.beta2, self.eps = lam, beta1, beta2, eps
        self.first = self.second = None

    def row(self, t: int, w: np.ndarray, signed: np.ndarray, violated: bool) -> None:
        if self.first is None:
            self.first, self.second, self.buffer = np.zeros_like(w), np.zeros_like(w), np.empty_like(w)
        self.first *= self.beta1
        self.first -= (1 - self.beta1) * signed  # the gradient is -signed
        np.square(signed, out=self.buffer)
        self.buffer *= 1 - self.beta2
        self.second *= self.beta2
        self.second += self.buffer
        if violated:
            seen1, seen2 = 1 - self.beta1 ** t, 1 - self.beta2 ** t
            np.sqrt(self.second / seen2, out=self.buffer)
            self.buffer += self.eps
            np.divide(self.first, self.buffer, out=self.buffer)
            self.buffer *= self.lam * math.sqrt(seen2) / seen1 ** 2
            w -= self.buffer


class BallRule:
    """Subgradient steps of length 5 / sqrt(t) on violated rows, kept in the ball of
    radius 1 / lam."""

    def __init__(self, lam: float):
        self.radius = 1.0 / lam

    def row(self, t: int, w: np.ndarray, signed: np.ndarray, violated: bool) -> None:
        if violated:
            w += signed * (5.0 / math.sqrt(t))
            length = math.sqrt(w @ w)
            if length > self.radius:
                w *= self.radius / length


def train_rows(X: np.ndarray, y: np.ndarray, rule, features: str = "raw") -> np.ndarray:
    """One pass of an online hinge learner.  Features are expanded a row at a time
    (a batch never holds its n x d^2 matrix)."""
    feat = _row_feat(features)
    w = np.zeros(feature_width(X.shape[1], features))
    for t, (x, label) in enumerate(zip(X, y), start=1):
        signed = label * feat(x)
        rule.row(t, w, signed, bool(signed @ w < 1))
    return w


def parallel_svm(train: DataFrame, batch_size: int, seed: int, features: str = "raw",
                 method: str = "adam", lam: float = 1.0, beta1: float = 0.9,
                 beta2: float = 0.999) -> DataFrame:
    """split into batches of ~batch_size, shuffle each batch (md5
    order), train sequentially inside the batch (``applyInPandas``: one
    bounded group per batch), then average the batch models (D5).

    Returns the model table ``j, w``.
    """
    n = train.count()
    nb = max(1, int(math.ceil(n / batch_size)))
    b = hash_batches(train.select("id", "y", "x"), nb, seed)
    b = b.withColumn("_o", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))))

    block = BLOCK

    def _train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_o", "id"])
        X = np.stack(pdf["x"].to_numpy()).astype(np.float64)
        y = pdf["y"].to_numpy(dtype=np.float64)
        w = train_rows(X, y, AdamRule(lam, beta1, beta2) if method == "adam" else BallRule(lam), features)
        blocks = [w[j:j + block] for j in range(0, len(w), block)]
        return pd.DataFrame({"task": int(pdf["batch"].iloc[0] % (1 << 31)), "key": np.arange(len(blocks)), "sums": [np.append(1.0, v) for v in blocks]})

    per_batch = by_key(b, "batch").groupBy("batch").applyInPandas(_train, "task int, key bigint, sums array<double>")
    # The mean of the batches' models, added up in arrays of a block each
    mean = F.transform(F.slice("sums", 2, BLOCK), lambda v: v / F.element_at("sums", 1))
    return (add_up(per_batch).select("key", F.posexplode(mean).alias("at", "w"))
            .select((F.col("key") * BLOCK + F.col("at")).cast("int").alias("j"), "w"))


def weight_average(per_batch: DataFrame) -> DataFrame:
    """Element-wise mean of per-batch models (long form, partial+final avg)."""
    return per_batch.groupBy("j").agg(F.avg("w").alias("w"))


# ------------------------------------------------------------------ Pegasos
def l1_project_np(v: np.ndarray, z: float) -> np.ndarray:
    if np.abs(v).sum() <= z:
        return v
    u = np.sort(np.abs(v))[::-1]
    css = np.cumsum(u)
    j = np.arange(1, len(u) + 1)
    rho = np.nonzero(u - (css - z) / j > 0)[0][-1]
    theta = (css[rho] - z) / (rho + 1)
    return np.sign(v) * np.maximum(np.abs(v) - theta, 0)


def l1_projection(model: DataFrame, z: float) -> DataFrame:
    """Euclidean projection of a model table ``j, w`` onto the L1 ball of radius z.

    Sort |w| descending with a running sum (the model table is model-sized,
    so one ordered window over it is acceptable); theta from the last index
    where u_j > (cumsum_j - z)/j; soft threshold.
    """
    from pyspark.sql import Window
    tot = model.agg(F.sum(F.abs("w"))).first()[0] or 0.0
    if tot <= z:
        return model.select("j", "w")
    w = Window.orderBy(F.abs("w").desc(), "j")
    r = (model.withColumn("_rk", F.row_number().over(w))
         .withColumn("_cs", F.sum(F.abs("w")).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    ok = r.where(F.abs("w") - (F.col("_cs") - F.lit(z)) / F.col("_rk") > 0)
    best = ok.orderBy(F.col("_rk").desc()).limit(1).select("_rk", "_cs").first()
    theta = (best["_cs"] - z) / best["_rk"]
    return model.select("j", (F.signum("w") * F.greatest(F.abs("w") - F.lit(theta), F.lit(0.0))).alias("w"))


def pegasos(train: DataFrame, lam: float, steps: int, features: str = "raw", batch_size: int | None = None,
            seed: int = 0, projection: str = "l2", l1_radius: float | None = None) -> np.ndarray:
    """mini-batch Pegasos.  Step t: eta = 1/(lambda t); A_t = batch
    (t-1) mod nb (all rows when batch_size is None); violators of the
    current w contribute y x; w = (1 - eta lambda) w + eta/|A_t| sum; then
    project (L2 ball radius 1/sqrt(lambda), or the L1 ball for F7).  Each
    step is one distributed vector sum."""
    data = train.select("id", "y", "x")
    first = data.select("x").first()
    d = len(first["x"]) if first else 0
    w, nb = np.zeros(feature_width(d, features)), 1
    if batch_size:
        nb = max(1, int(math.ceil(data.count() / batch_size)))
        # a step reads its own batch only
        path = f"{checkpoint_dir(train.sparkSession).rstrip('/')}/batches-{uuid.uuid4().hex}"
        hash_batches(data, nb, seed).repartition("batch").write.partitionBy("batch").parquet(path)
        data = train.sparkSession.read.schema("id bigint, y double, x array<double>, batch bigint").parquet(path)
        own = False
    else:
        # the rows as the caller keeps them are this same table: releasing it here would release theirs
        own = data.storageLevel == StorageLevel.NONE
        data = data.persist(StorageLevel.MEMORY_AND_DISK) if own else data
    for t in range(1, steps + 1):
        s, n_t = hinge_sums(data.where(F.col("batch") == (t - 1) % nb) if batch_size else data, w, d, features)
        eta = 1.0 / (lam * t)
        w = (1 - eta * lam) * w + (eta / max(n_t, 1)) * s
        if projection == "l1":
            w = l1_project_np(w, l1_radius)
        else:
            nrm = np.linalg.norm(w)
            if nrm > 0:
                w = w * min(1.0, (1.0 / math.sqrt(lam)) / nrm)
    if own:
        data.unpersist()
    return w


# ------------------------------------------------------------------ kernels
def rbf_kernel_scores(df: DataFrame, sv: np.ndarray, coef: np.ndarray, gamma: float,
                      x_col: str = "x") -> DataFrame:
    """sum_i alpha_i y_i exp(-gamma ||x - x_i||^2) for a bounded support set."""
    if sv.size > MAX_MODEL:
        raise ValueError("support set too large")

    norms = (sv * sv).sum(1)

    @F.pandas_udf(T.DoubleType())
    def _k(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=float)
        X = np.stack(xs.to_numpy()).astype(np.float64)
        out = np.empty(len(X))
        step = max(1, (1 << 22) // max(1, len(sv)))  # a step holds <= 4M kernel values
        for s in range(0, len(X), step):
            part = X[s:s + step]
            # |x - v|^2 from norms and one matrix product
            D2 = (part * part).sum(1)[:, None] + norms[None] - 2 * (part @ sv.T)
            out[s:s + step] = np.exp(-gamma * np.maximum(D2, 0)) @ coef
        return pd.Series(out)

    return df.withColumn("kscore", _k(F.col(x_col)))


# ------------------------------------------------------------------ active learning
def active_learning_round(pool: DataFrame, labeled: DataFrame, oracle: DataFrame, w: np.ndarray,
                          m: int, lam: float, steps: int) -> tuple[DataFrame, np.ndarray]:
    """F8: score the unlabelled pool, take the m most uncertain (E6), look their
    labels up in the oracle table (join), add them, retrain with Pegasos."""
    unl = pool.join(labeled.select("id"), "id", "left_anti")
    d = len(pool.select("x").first()["x"])
    scored = unl.withColumn("score", score_udf(w, d)(F.col("x")))
    pick = uncertainty_topm(scored, m).select("id", "x")
    new = pick.join(oracle.select("id", "y"), "id")
    lab = labeled.select("id", "y", "x").unionByName(new.select("id", "y", "x"))
    lab = lab.persist(StorageLevel.MEMORY_AND_DISK)
    w2 = pegasos(lab, lam, steps)
    return lab, w2


def margin_selection(candidates: DataFrame, labeled: DataFrame, lam: float, steps: int,
                     max_labeled: int = 100_000, rule: str = "max-min") -> DataFrame:
    """for each candidate x and label +-1, retrain on labeled + (x, label)
    (a small full-batch Pegasos per group) and measure the margin of the new
    model; score = min(m+, m-), or with rule "ratio" min(m+/m-, m-/m+) (0 unless
    both margins are positive).  The labelled set must be bounded: it is
    shipped to every group (checked against ``max_labeled``)."""
    if rule not in ("max-min", "ratio"):
        raise ValueError(rule)
    n = labeled.count()
    if n > max_labeled:
        raise ValueError("labelled set too large for per-candidate retraining")
    L = labeled.select("x", "y").collect()
    LX = np.array([r["x"] for r in L], dtype=np.float64)
    Ly = np.array([r["y"] for r in L], dtype=np.float64)

    def _train(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.asarray(pdf["x"].iloc[0], dtype=np.float64)
        yc = float(pdf["lab"].iloc[0])
        X = np.vstack([LX, x[None]]) if len(LX) else x[None]
        y = np.concatenate([Ly, [yc]])
        w = np.zeros(X.shape[1])
        for t in range(1, steps + 1):
            viol = y * (X @ w) < 1
            eta = 1.0 / (lam * t)
            w = (1 - eta * lam) * w + (eta / len(y)) * (y[viol] @ X[viol])
            nrm = np.linalg.norm(w)
            if nrm > 0:
                w *= min(1.0, (1 / math.sqrt(lam)) / nrm)
        nrm = np.linalg.norm(w)
        margin = float(np.min(y * (X @ w)) / nrm) if nrm > 0 else 0.0
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "lab": [yc], "margin": [margin]})

    grid = candidates.select("id", "x", F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("lab"))
    res = by_key(grid, "id", "lab").groupBy("id", "lab").applyInPandas(_train, "id bigint, lab double, margin double")
    if rule == "ratio":
        lo, hi = F.min("margin"), F.max("margin")
        return res.groupBy("id").agg(F.when(lo > 0, lo / hi).otherwise(F.lit(0.0)).alias("score"))
    return res.groupBy("id").agg(F.min("margin").alias("score"))
