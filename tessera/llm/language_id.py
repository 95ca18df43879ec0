"""Hierarchical language identification.

First the language family, then, inside it, one-versus-one linear support
vector machines between its closely related languages.  Features are hashed
byte n-grams of the whole text (square roots of relative counts).  Each
machine is fitted in a task of its own by dual coordinate descent on a sample
of at most about ``per_lang`` texts of each language; only the fitted vectors
come to the driver.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import byte_rows, steps
from tessera.llm.hashing_features import ngram_counts
from tessera.sources.parallel import spread

BUCKETS = 4096
PER_LANG = 1200
UNKNOWN = "und"
#: Families of some languages; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str, families: dict | None = None) -> str:
    for name, langs in (families or FAMILIES).items():
        if lang in langs:
            return name
    return f"only-{lang}"


def features(col: pa.Array, buckets: int = BUCKETS):
    """Yields (first row, matrix) of the texts of an Arrow column, a bounded block at a time."""
    raw, off = byte_rows(col)
    for i, j in steps(off):
        for s in range(i, j, 256):
            e = min(j, s + 256)
            x = ngram_counts(raw[off[s]:off[e]], off[s:e + 1] - off[s], buckets)
            yield s, np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Weights and bias (last) of a linear SVM with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, alpha, diag = np.zeros(x.shape[1]), np.zeros(len(x)), 0.5 / c
    q = np.einsum("ij,ij->i", x, x, dtype=np.float64) + diag
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = max(alpha[i] - (y[i] * (x[i] @ w) - 1 + diag * alpha[i]) / q[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _sample(rows: DataFrame, counts: dict[str, int], per_lang: int) -> DataFrame:
    """About ``per_lang`` texts of each language, chosen where they are scanned by a hash of id and text."""
    # the unsigned top 31 bits of the hash against the share that is wanted
    bound = [x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, per_lang / n) * float(1 << 31)))]
    mark = F.xxhash64("doc_id", "text")
    return (rows.where(F.shiftrightunsigned(mark, 33) < F.try_element_at(F.create_map(*bound), F.col("lang")))
            .select("text", "lang", mark.alias("o")))


def train(docs: DataFrame, per_lang: int = PER_LANG, buckets: int = BUCKETS, families: dict | None = None) -> dict:
    """Model from rows ``doc_id, text, lang``; null texts, languages and ids are not learned from."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # as many as there are languages
    langs = sorted(counts)
    tree: dict[str, list[str]] = {}
    for x in langs:
        tree.setdefault(family_of(x, families), []).append(x)
    jobs = [("family", a, b) for a, b in combinations(sorted(tree), 2)]
    jobs += [("lang", a, b) for ls in tree.values() for a, b in combinations(ls, 2)]
    model = {"tree": tree, "buckets": buckets, "jobs": jobs, "w": np.zeros((buckets + 1, 0))}
    if not jobs:
        return model
    sides = {x: [(k, 1 if side == p[1] else -1) for k, p in enumerate(jobs)
                 for side in [x if p[0] == "lang" else family_of(x, families)] if side in p[1:]] for x in langs}

    def vectors(batches):
        for b in batches:
            out = []
            for s, m in features(b.column(0), buckets):
                for r in range(len(m)):
                    out += [(k, y, b.column(2)[s + r].as_py(), m[r].astype(np.float16).tobytes()) for k, y in sides[b.column(1)[s + r].as_py()]]
            for s in range(0, max(1, len(out)), 512):
                cols = list(zip(*out[s:s + 512])) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["job", "y", "o", "x"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "y"])
        x = np.frombuffer(b"".join(pdf["x"]), np.float16).reshape(len(pdf), -1).astype(np.float32)
        w = fit_svm(x, pdf["y"].to_numpy(np.float64))
        return pd.DataFrame({"job": [pdf["job"].iloc[0]], "w": [w.tolist()]})

    got = (_sample(rows, counts, per_lang).mapInArrow(vectors, "job int, y int, o bigint, x binary")
           .groupBy("job").applyInPandas(fit, "job int, w array<double>").collect())  # one vector for each pair
    model["w"] = np.zeros((buckets + 1, len(jobs)))
    for r in got:
        model["w"][:, r.job] = r.w
    return model


def _vote(margin: np.ndarray, jobs: list, kind: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Winner (index into names) of the pairwise machines, and its smallest margin."""
    n = len(margin)
    if len(names) == 1:
        return np.zeros(n, int), np.full(n, np.inf)
    wins, total = np.zeros((n, len(names))), np.zeros((n, len(names)))
    least = np.full((n, len(names)), np.inf)
    for k, (what, a, b) in enumerate(jobs):
        if what == kind and a in names and b in names:
            for x, m in ((names.index(a), margin[:, k]), (names.index(b), -margin[:, k])):
                wins[:, x] += m > 0
                total[:, x] += m
                least[:, x] = np.minimum(least[:, x], m)
    best = np.argmax(wins + 1e-3 * np.tanh(total / len(names)), axis=1)
    return best, least[np.arange(n), best]


def predict(model: dict, col: pa.Array) -> tuple[list[str], np.ndarray]:
    """Languages and scores of an Arrow column of texts."""
    langs, scores = [UNKNOWN] * len(col), np.zeros(len(col))
    tree, jobs, w = model["tree"], model["jobs"], model["w"]
    if not tree:
        return langs, scores
    fams = sorted(tree)
    for s, x in features(col, model["buckets"]):
        margin = x @ w[:-1] + w[-1]
        f, fm = _vote(margin, jobs, "family", fams)
        for k, name in enumerate(fams):
            at = np.flatnonzero(f == k)
            l, lm = _vote(margin[at], jobs, "lang", tree[name])
            low = np.minimum(np.minimum(fm[at], lm), 20.0)
            scores[s + at] = 1 / (1 + np.exp(-4 * low))
            for r, i in zip(at.tolist(), l.tolist()):
                langs[s + r] = tree[name][i]
    for r in range(len(col)):
        t = col[r].as_py()
        if not t or not _LETTER.search(t):
            langs[r], scores[r] = UNKNOWN, 0.0
    return langs, scores


def identify(docs: DataFrame, model: dict, text_col: str = "text", keep_cols: tuple = ("doc_id",)) -> DataFrame:
    """``keep_cols`` and ``lang_pred, score`` for every row of ``docs``.

    Texts that are null or hold no letter get ``und`` and score 0, as does
    everything if nothing was learned.  Repeated rows give repeated results.
    """
    d = spread(docs.select(*keep_cols, *([] if text_col in keep_cols else [text_col])))
    at, names = d.columns.index(text_col), list(keep_cols)
    kind = T.StructType(d.schema.fields[:len(names)])

    def run(batches):
        for b in batches:
            langs, scores = predict(model, b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(langs, pa.string()), pa.array(scores)],
                                             names=[*names, "lang_pred", "score"])

    return d.mapInArrow(run, kind.add("lang_pred", "string").add("score", "double"))


def held_out_mod(id_col: str, m: int, r: int):
    """Whether crc32 of the id's text leaves ``r`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % m == r, F.lit(False))
