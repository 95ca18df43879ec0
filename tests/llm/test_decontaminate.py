import random

from tessera.llm import decontaminate as D
from tessera.llm.queries import ORACLES, QUERIES
from tessera.plans.check import compare, duck


def sh(t, k=5):
    w = (t or "").lower().split()
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({" ".join(w)} if w else set())


def test_against_brute_force(docs_of, spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 20, 60, 200])))) for i in range(40)]
    items += [(100, None), (101, " "), (None, items[0][1]), (102, "same same same same same same")]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.choice([0, 4, 50, 700, 3000]))]
        t = rng.choice(items)[1] or ""
        v = t.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            if v:
                v[rng.randrange(len(v))] = "changed"
        at = rng.randrange(len(w) + 1)
        docs.append((i, " ".join(w[:at] + v + w[at:]).upper()))
    docs += [(900, None), (901, ""), (None, items[3][1]), docs[0], (902, items[0][1]), (902, items[5][1])]
    got = {(r.item_id, r.doc_id): (r.n_item, r.n_shared) for r in D.contained(docs_of(docs), docs_of(items, "item_id bigint, text string")).collect()}
    want = {}
    for i, t in items:
        for d, x in docs:
            if i is not None and d is not None and sh(t):
                n = len(sh(t) & sh(x))
                if n >= 0.8 * len(sh(t)) - 1e-9:
                    want[i, d] = (len(sh(t)), max(n, want.get((i, d), (0, 0))[1]))
    assert got == want and len(want) > 60


def test_without_broadcast_and_empty(docs_of, spark, monkeypatch):
    docs, items = docs_of([(1, "a b c d e f g h")]), docs_of([(7, "b c d e f g")], "item_id bigint, text string")
    monkeypatch.setattr(D, "SKETCH_ROWS", 0)
    assert [tuple(r) for r in D.contained(docs, items).collect()] == [(7, 1, 2, 2, 1.0)]
    assert D.contained(docs_of([]), items).count() == 0
    assert D.contained(docs, docs_of([], "item_id bigint, text string")).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    r = compare(QUERIES["op10_decontamination"](spark, sf), duck(sf), ORACLES["op10_decontamination"])
    assert r["match"] and r["rows"] > 0, r
