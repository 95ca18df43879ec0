import random

import pytest

from tessera.llm import suffix_dedup as S


def brute(rows, m):
    """rows: (doc_id, bytes) -> {doc_id: (spans, kept)}"""
    low = {}
    for d, b in rows:
        for i in range(len(b) - m + 1):
            s = b[i:i + m]
            low[s] = min(low.get(s, d), d)
    out = {}
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - m + 1):
            if low[b[i:i + m]] < d:
                gone[i:i + m] = b"\1" * m
        spans, i = [], 0
        while i < len(b):
            j = i
            while j < len(b) and gone[j] == gone[i]:
                j += 1
            if gone[i]:
                spans.append((i, j))
            i = j
        out[d] = (spans, bytes(c for c, g in zip(b, gone) if not g))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aäbcdeno") for _ in range(rng.randrange(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.choice([8, 9, 10, 12, 20, 60])) for _ in range(12)] + ["=" * 70, "ab" * 40, "x" * 49, "y" * 50]
    rows = []
    for i in rng.sample(range(10_000), n):
        parts = [text(rng.choice([0, 3, 40])) if rng.random() < 0.6 else rng.choice(shared[:3] if rng.random() < 0.4 else shared) for _ in range(rng.choice([0, 1, 3, 8]))]
        rows.append((i, "".join(parts) if rng.random() < 0.3 else "\n".join(parts)))
    for i, (d, t) in enumerate(rng.sample(rows, n // 3)):
        rows.append((20_000 + i, t if i % 2 else t[:len(t) // 2] + "edit" + t[len(t) // 2:]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs_of, seed):
    rows = corpus(seed, 150)
    want = brute([(d, t.encode()) for d, t in rows], 50)
    odd = [(50_001, None), (50_002, ""), (None, rows[0][1]), (None, rows[1][1]), rows[4], (-5, "z" * 20)]
    got = S.remove_repeats(docs_of(rows + odd), group_bytes=2000 if seed == 1 else S.GROUP_BYTES).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        if r.doc_id is None:
            assert not r.spans and bytes(r.kept).decode() in (rows[0][1], rows[1][1])
        elif r.doc_id in want:
            assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id], r.doc_id
        else:
            assert not r.spans and r.n_bytes == len(r.kept)
    assert sum(bool(v[0]) for v in want.values()) > 50


def test_steps_and_long_texts(docs_of, monkeypatch):
    rng = random.Random(7)
    long = "".join(rng.choice("abcdef ") for _ in range(30_000))
    rows = [(3, long), (9, "q" * 10 + long[5_000:20_000] + "w" * 10), (4, long[::-1]), (12, long[100:149] + "-" + long[7:57])]
    want = brute([(d, t.encode()) for d, t in rows], 50)
    monkeypatch.setattr(S, "STEP", 777)
    off = S.np.array([0, 30_000])
    row, h, a, z, at = S.parse(S.np.frombuffer(long.encode(), S.np.uint8), off)
    assert (z - a + 1).sum() == 30_000 - 49 and (at >= a - 34).all() and (at <= a + 34).all()
    got = {r.doc_id: ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in S.remove_repeats(docs_of(rows)).collect()}
    assert got == want


def test_two_texts_under_one_id_and_empty(docs_of):
    t = "this passage is certainly longer than fifty bytes, is it not? yes."
    got = S.remove_repeats(docs_of([(1, "first " + t), (2, t + " one"), (2, t + " two")])).collect()
    assert sorted(len(r.spans) for r in got if r.doc_id == 2) == [0, 1]
    assert S.remove_repeats(docs_of([])).count() == 0
