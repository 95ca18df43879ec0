"""Shingling and MinHash work on bounded parts of a batch and give what one pass over each text gives."""

import hashlib
import re

import numpy as np

from tessera.functions.hashing import HASH_MAX, hash_coefficients
from tessera.operators import lsh
from tessera.sources.lines import parse_shingle_lines


def plain(text, k=3):
    w = [t for t in re.split(r"[ \t\n\x0b\f\r]+", text.lower()) if t]
    return sorted({int(hashlib.md5(" ".join(w[i:i + k]).encode()).hexdigest()[:15], 16) for i in range(max(1, len(w) - k + 1))}) if w else []


def test_steps_are_bounded_and_whole():
    size = np.array([5, 0, 3, 40, 1, 1, 1, 0, 9, 2])
    cuts = list(lsh._cuts(np.r_[0, np.cumsum(size)], 10))
    assert [i for i, _ in cuts] == [0] + [j for _, j in cuts[:-1]] and cuts[-1][1] == len(size)
    assert all(size[i:j].sum() <= 10 or j == i + 1 for i, j in cuts)


def test_odd_texts_and_long_rows(spark):
    texts = ["", " \t\x0b\f\r\n", "One", "a b", "a\x0bb\x1cc d e f g h", "İstanbul Ü ß x y z", "w " * 500,
             " ".join(str(i * 7 % 5003) for i in range(50000)), None]
    docs = [(i, texts[i % len(texts)]) for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r for r in lsh.shingle(d, with_key=True).collect()}
    want = {i: plain(t) for i, t in docs if t and plain(t)}
    assert {i: list(r.shingles) for i, r in got.items()} == want
    assert all(r.skey == hashlib.md5(np.array(want[i], np.int64).tobytes()).hexdigest() for i, r in got.items())
    a, b = hash_coefficients(7, 42)
    sets = spark.createDataFrame([*want.items(), (900, []), (901, None)], "doc_id bigint, shingles array<bigint>").coalesce(1)
    for r in lsh.minhash(sets, 7, 42).collect():
        s = want.get(r.doc_id, [])
        exp = ((np.array(s, np.uint64)[:, None] * a + b) >> np.uint64(3)).min(axis=0) if s else [HASH_MAX] * 7
        assert list(r.sig) == [int(v) for v in exp]


def test_lines_with_odd_fields(spark):
    lines = [("PAGE_4 7  7 9 ",), ("PAGE_5 x 1",), (" \tPAGE_6 3\t8",), ("PAGE_7",), ("PAGE_8 1.5",), (None,), ("PAGE_9 99999999999999999999",)]
    got = parse_shingle_lines(spark.createDataFrame(lines, "value string")).collect()
    assert {r.doc_id: list(r.shingles) for r in got} == {4: [7, 9], 6: [3, 8]}
