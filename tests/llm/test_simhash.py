import random
import re

import numpy as np
import xxhash

from tessera.llm import simhash as S


def brute_fp(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius):
    par = list(range(len(ids)))

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                par[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = min(low.get(r, d), d)
    return [low[find(i)] for i in range(len(ids))]


def test_fingerprint_matches_definition():
    for t in ["", " \t\n", "One", "Two words", "ÀB Éc d e\x0bf", "a b c d e f A B C " * 50, "x " * 70000]:
        assert S.fingerprint(t.encode()) == brute_fp(t)


def test_groups_against_brute_force(docs_of, spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 40, 300]))]
        rows.append((i * 3, " ".join(w)))
        for c in range(rng.choice([0, 0, 1, 4])):
            v = list(w)
            if v and c:
                v[rng.randrange(len(v))] = "edited"
            rows.append((1000 + i * 10 + c, "  ".join(v).upper() if c == 1 else " ".join(v)))
    rows += [(5000, None), (5001, ""), rows[3], (None, rows[3][1])]
    got = S.simhash_groups(docs_of(rows)).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in rows if r[0] is not None]
    fps = [brute_fp(r[1]) for r in rows if r[0] is not None]
    want = {(d, f, c) for d, f, c in zip(ids, fps, brute_components(ids, fps, 2))}
    assert {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id is not None for r in got if r.doc_id is None] == [True]
    assert S.simhash_groups(docs_of([])).count() == 0


def test_crowded_buckets_are_split_without_loss(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 3)]
    fps = set()
    for b in base:
        for _ in range(150):
            v = b
            for k in rng.integers(0, 64, 3):
                v ^= 1 << int(k)
            fps.add(v)
    fps = sorted(fps)
    df = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in fps], "fp bigint")
    for tile in (2048, 16):
        from tessera.operators.components import connected_components
        e = S.close_fingerprints(df, 2, tile)
        comp = {r.node % 2**64: r.component for r in connected_components(e).collect()}
        want = brute_components(fps, fps, 2)
        groups = {}
        for v, c in zip(fps, want):
            groups.setdefault(c, set()).add(v)
        got = {}
        for v in fps:
            got.setdefault(comp.get(v, (v, "alone")), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_bucket_kernel_counts_exactly():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 2**63, 300).astype(np.uint64)
    v[100:200] = v[:100] ^ np.uint64(5)
    for radius in (0, 1, 2, 3, 6):
        i, j = S.bucket_links(v, radius)
        want = {(a, b) for a in range(300) for b in range(a + 1, 300) if bin(int(v[a]) ^ int(v[b])).count("1") <= radius}
        assert set(zip(i.tolist(), j.tolist())) == want
