"""Predictions and scores of op4 and op5 on whole documents equal plain loops over one text at a time."""

import math
import re

import numpy as np

from tessera.llm import hashing_features as H
from tessera.llm import language_id as L
from tessera.llm import quality as Q

SF = "/root/testdata/sf0.001"
M = (1 << 64) - 1
MIX = int(H.MIX)


def mix(h):
    h = (h ^ (h >> 31)) * MIX & M
    return h ^ (h >> 29)


def lower(b):
    return b + 32 if 65 <= b <= 90 else b


def plain_language(model, text):
    b = [lower(x) for x in (text or "").encode()]
    b = [x if 97 <= x <= 122 or x >= 128 else 32 for x in b]
    x = np.zeros(model["buckets"])
    for k in (2, 3, 4):
        for i in range(len(b) - k + 1):
            h = 0
            for y in b[i:i + k]:
                h = (h * 257 + y) & M
            x[mix((h + k * MIX) & M) & (model["buckets"] - 1)] += 1
    x = np.sqrt(x / max(x.sum(), 1))
    if not text or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    margin = {j: float(x @ model["w"][:-1, k] + model["w"][-1, k]) for k, j in enumerate(model["jobs"])}

    def winner(kind, names):
        if len(names) == 1:
            return names[0], math.inf
        wins, total, least = ({n: v for n in names} for v in (0, 0.0, math.inf))
        for (what, a, c), m in margin.items():
            if what == kind and a in names and c in names:
                for n, s in ((a, m), (c, -m)):
                    wins[n], total[n], least[n] = wins[n] + (s > 0), total[n] + s, min(least[n], s)
        best = max(names, key=lambda n: wins[n] + 1e-3 * math.tanh(total[n] / len(names)))
        return best, least[best]
    fam, fm = winner("family", sorted(model["tree"]))
    lang, lm = winner("lang", model["tree"][fam])
    return lang, 1 / (1 + math.exp(-4 * min(fm, lm, 20.0)))


def test_language_predictions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000")
    docs = docs.unionByName(docs.sparkSession.createDataFrame(
        [(7001, None, None, None, None), (7002, "", "en", "s", 0), (7003, "12 34!", "en", "s", 6), (7004, "ä", "de", "s", 1)], docs.schema))
    model = L.train(docs.where(~L.held_out_mod("doc_id", 4, 2)))
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(docs, model).collect()}
    assert len(got) > 150
    for d in sorted(text, key=lambda d: (d < 7000, d))[:90]:
        lang, score = plain_language(model, text[d])
        assert got[d][0] == lang and abs(got[d][1] - score) < 1e-3, d


def run_hash(values):
    table, power = H._TABLE.tolist(), H._POW.tolist()
    return mix(sum(table[v] * power[i % 64] for i, v in enumerate(values)) & M)


def kind(b):
    return 3 if 48 <= b <= 57 else 2 if 65 <= b <= 90 else 1 if 97 <= b <= 122 or b >= 128 else b


def plain_score(weights, text):
    bits = (len(weights) - 1).bit_length() - 1
    total = n = 0
    before, s1, s2 = 0, 1, 2
    for w in re.split(rb"[\t-\r ]+", (text or "").encode()):
        if not w:
            continue
        h = run_hash([lower(b) for b in w])
        classes = [kind(b) for b in w]
        shape = run_hash([c for i, c in enumerate(classes) if i == 0 or c != classes[i - 1]])
        if n and h == before:
            shape ^= int(Q._REPEAT)
        pair = (shape * MIX + s1) & M
        for f in (h, mix((h * MIX + before) & M), mix((pair + 3) & M), mix((pair * MIX + s2 + 7) & M)):
            total += weights[f >> (64 - bits)]
            n += 1
        s2, s1, before = (2 if n == 4 else s1), shape, h      # the second word has no word two before it
    z = total * Q.SCALE / max(n, 1) + weights[-1]
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def test_quality_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000")
    docs = docs.unionByName(docs.sparkSession.createDataFrame(
        [(7001, None, None, None, None), (7002, "", "en", "s", 0), (7003, "one", "en", "s", 3), (7004, "a  A a\nB2 b2 B2", "en", "s", 9)], docs.schema))
    w = Q.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert np.count_nonzero(w) > 50
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.score for r in Q.score(docs, w).collect()}
    for d in sorted(text, key=lambda d: (d < 7000, d))[:150]:
        assert abs(got[d] - plain_score(w, text[d])) < 1e-9, d
