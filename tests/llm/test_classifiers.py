import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import hashing_features as H
from tessera.llm import language_id as L
from tessera.llm import quality as Q
from tessera.llm.common import byte_rows

SF = "/root/testdata/sf0.01"


def test_words_are_hashed_alike_wherever_they_stand():
    col = pa.array(["One two", None, "", " two  ONE\n", "a\tb two"])
    row, h, shape = H.words(*byte_rows(col))
    assert row.tolist() == [0, 0, 3, 3, 4, 4, 4]
    assert h[0] == h[3] and h[1] == h[2] == h[6] and len(set(h.tolist())) == 4
    assert shape[0] != shape[3] and shape[1] == shape[2]


def test_ngrams_stay_in_their_row():
    m = H.ngram_counts(*byte_rows(pa.array(["ab", "cd", "", "abcd"])), 4096, (2,))
    assert m.sum(axis=1).tolist() == [1, 1, 0, 3]
    one = H.ngram_counts(*byte_rows(pa.array(["ab"])), 4096, (2,))
    assert (m[0] == one[0]).all()


def test_language_accuracy_held_out_and_odd_rows(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = L.held_out_mod("doc_id", 4, 2)
    model = L.train(docs.where(~held), per_lang=80)
    assert model["tree"] == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    r = L.identify(docs, model, keep_cols=("doc_id", "lang")).where(held)
    n, ok = r.count(), r.where("lang = lang_pred").count()
    assert ok / n > 0.97
    odd = docs_of([(1, None), (2, ""), (3, "123 !!"), (4, "x"), (None, "und der die das " * 40000), (1, None)])
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in L.identify(odd, model).collect()), key=str)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [g[1] for g in got if g[0] is None] == ["de"]
    assert all(0 <= g[2] <= 1 for g in got)
    assert L.identify(docs_of([]), model).count() == 0


def test_language_without_labels(docs_of):
    d = docs_of([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in L.identify(d, L.train(d)).collect()] == [(1, "und", 0.0)]
    d = docs_of([(1, "some text", "en"), (2, "more", "en")], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in L.identify(d, L.train(d)).collect()} == {"en"}


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 10)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    w = L.fit_svm(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.98


def test_ftrl_follows_the_published_update():
    m = Q.Ftrl(3, alpha=0.1, beta=1.0, l1=0.01, l2=0.1)
    z, n = [0.0] * 4, [0.0] * 4
    rng = np.random.default_rng(2)
    for _ in range(50):
        i = np.sort(rng.choice(4, 2, replace=False))
        x, y = rng.normal(size=2), float(rng.integers(0, 2))
        w = [0.0 if abs(z[j]) <= 0.01 else -(z[j] - np.sign(z[j]) * 0.01) / ((1 + n[j] ** 0.5) / 0.1 + 0.1) for j in i]
        p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x))))
        for j, wj, xj in zip(i, w, x):
            g = (p - y) * xj
            s = ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / 0.1
            z[j] += g - s * wj
            n[j] += g * g
        m.learn(i, x, y)
    assert np.allclose(m.z, z) and np.allclose(m.n, n)


def test_quality_held_out_and_odd_rows(spark, docs_of):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = L.held_out_mod("doc_id", 5, 0)
    w = Q.train(docs, labels.where(~held))
    r = Q.score(docs, w).where(held).join(labels, "doc_id").withColumn("p", (F.col("score") >= 0.3).cast("int"))
    assert r.where("p = quality").count() / r.count() > 0.93
    odd = Q.score(docs_of([(1, None), (2, ""), (None, "a b"), (1, None), (3, "long " * 90000)]), w).collect()
    assert len(odd) == 5 and all(0 <= x.score <= 1 for x in odd)
    assert len({x.score for x in odd if x.doc_id in (1, 2)}) == 1
    assert Q.score(docs_of([]), w).count() == 0


def test_quality_conflicting_or_no_labels(spark, docs_of):
    d = docs_of([(1, "a b c"), (2, "d e f")])
    lab = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id bigint, quality int")
    w = Q.train(d, lab)
    assert not w.any()
    assert [r.score for r in Q.score(d, w).collect()] == pytest.approx([0.5, 0.5])


def test_sparse_features_equal_dense_sum():
    raw, off = byte_rows(pa.array(["a b a b", "", "c"]))
    row, idx = Q.ngrams(raw, off)
    for r, (i, v) in enumerate(Q._sparse(pa.array(["a b a b", "", "c"]), Q.BITS)):
        mine = idx[row == r]
        assert v.sum() == pytest.approx(Q.SCALE if len(mine) else 0)
        assert sorted(set(mine.tolist())) == i.tolist()
