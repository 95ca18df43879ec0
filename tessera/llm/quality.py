"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

A word gives four features: the lower-cased word, the word pair, and pairs and
triples of word shapes (runs of letters, capitals, digits and each other byte;
a word equal to the one before it has a shape of its own).  A text's value for
a feature is its share among all features of the text, times ``SCALE``.
Training takes a sample of at most ``max_train`` labelled rows, dealt to
``shards`` tasks that each run follow-the-regularised-leader updates; the
weights are averaged.  Scoring is a sparse dot product per text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import byte_rows, steps
from tessera.llm.hashing_features import MIX, mix, words
from tessera.sources.parallel import spread

BITS = 18
MAX_TRAIN = 12_000
SHARDS = 6
SCALE = 30.0
_REPEAT = np.uint64(0x5851F42D4C957F2D)


def ngrams(raw: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature index) of every feature of the texts of a buffer."""
    row, h, shape = words(raw, off)
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    prev, prev2 = np.roll(h, 1), np.roll(new, 1)
    prev[new] = 0
    shape = np.where(~new & (h == prev), shape ^ _REPEAT, shape)
    s1 = np.roll(shape, 1)
    s1[new] = 1
    s2 = np.roll(s1, 1)
    s2[new | prev2] = 2
    u = np.uint64
    feats = [h, mix(h * MIX + prev), mix(shape * MIX + s1 + u(3)), mix((shape * MIX + s1) * MIX + s2 + u(7))]
    idx = np.concatenate([(f >> u(64 - bits)).astype(np.int64) for f in feats])
    return np.tile(row, 4), idx


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss; index 0 of
    the last slot is the bias."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, i: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        sigma = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - sigma * w
        self.n[i] += g * g


def _sparse(col: pa.Array, bits: int):
    """Per text: (sorted feature indices, values)."""
    raw, off = byte_rows(col)
    for i, j in steps(off):
        row, idx = ngrams(raw[off[i]:off[j]], off[i:j + 1] - off[i], bits)
        key, count = np.unique(row << bits | idx, return_counts=True)
        cut = np.searchsorted(key, np.arange(j - i + 1) << bits)
        for r in range(j - i):
            k, c = key[cut[r]:cut[r + 1]], count[cut[r]:cut[r + 1]]
            yield k & (1 << bits) - 1, c * (SCALE / max(1, c.sum()))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_train: int = MAX_TRAIN,
          shards: int = SHARDS, bits: int = BITS, rounds: int = 4) -> np.ndarray:
    """Weights (2^bits and a bias) from ``docs(doc_id, text)`` and ``labels(doc_id, label)``.

    Ids with labels that disagree, null ids and null labels are not learned
    from; with nothing to learn all weights are 0.
    """
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id")
           .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2")).where("y = y2").select("doc_id", "y"))
    # a bounded table: max_train rows of an id and a label
    sample = F.broadcast(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", F.col("y").cast("int").alias("y"))

    def vectors(batches):
        for b in batches:
            out = [(o, y, i.astype(np.int32).tobytes(), v.astype(np.float32).tobytes())
                   for o, y, (i, v) in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), _sparse(b.column(1), bits))]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["o", "y", "i", "v"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "y", "i"])
        m, bias = Ftrl(1 << bits), np.array([1 << bits])
        data = [(np.concatenate([np.frombuffer(i, np.int32), bias]), np.append(np.frombuffer(v, np.float32), 1.0), float(y))
                for i, v, y in zip(pdf["i"], pdf["v"], pdf["y"])]
        rng = np.random.default_rng(11)
        for _ in range(rounds):
            for k in rng.permutation(len(data)):
                m.learn(*data[k])
        w = m.weights(slice(None))
        at = np.flatnonzero(w)
        return pd.DataFrame({"j": at, "w": w[at], "size": float(len(data))})

    made = (rows.mapInArrow(vectors, "o bigint, y int, i binary, v binary")
            .withColumn("shard", F.pmod(F.xxhash64("o", F.lit("shard")), F.lit(shards)))
            .groupBy("shard").applyInPandas(fit, "j bigint, w double, size double"))
    out = np.zeros((1 << bits) + 1)
    got = made.groupBy("j").agg(F.sum("w").alias("w")).toPandas()  # at most as many rows as weights
    out[got["j"].to_numpy()] = got["w"].to_numpy() / shards
    return out


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", keep_cols: tuple = ("doc_id",)) -> DataFrame:
    """``keep_cols`` and ``score`` (0 to 1) for every row; null counts as empty,
    and an empty text's score comes from the bias alone."""
    bits = (len(weights) - 1).bit_length() - 1
    w, bias = weights[:-1], float(weights[-1])
    d = spread(docs.select(*keep_cols, *([] if text_col in keep_cols else [text_col])))
    at, names = d.columns.index(text_col), list(keep_cols)
    kind = T.StructType(d.schema.fields[:len(names)])

    def run(batches):
        for b in batches:
            raw, off = byte_rows(b.column(at))
            dot = np.zeros(len(off) - 1)
            for i, j in steps(off):
                row, idx = ngrams(raw[off[i]:off[j]], off[i:j + 1] - off[i], bits)
                n = np.maximum(np.bincount(row, minlength=j - i), 1)
                dot[i:j] = np.bincount(row, w[idx], minlength=j - i) * SCALE / n
            p = 1 / (1 + np.exp(-np.clip(dot + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(p)], names=[*names, "score"])

    return d.mapInArrow(run, kind.add("score", "double"))
