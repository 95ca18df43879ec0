import hashlib
import random
from collections import defaultdict

import pytest

from tessera.llm import mixing as M
from tessera.llm.queries import ORACLES, QUERIES
from tessera.plans.check import compare, duck

S = "doc_id bigint, text string, domain string, lang string, source string"


def fill(budget, kids):
    """kids: {name: (cap, weight)} -> quotas, by repeated division."""
    got, left, open_ = {k: 0.0 for k in kids}, budget, {k for k in kids if kids[k][1] > 0}
    while open_ and left > 1e-9:
        w = sum(kids[k][1] for k in open_)
        full = [k for k in open_ if kids[k][0] - got[k] <= left * kids[k][1] / w + 1e-9]
        if not full:
            for k in open_:
                got[k] += left * kids[k][1] / w
            return got
        for k in full:
            left -= kids[k][0] - got[k]
            got[k] = kids[k][0]
        open_ -= set(full)
    return got


def brute(rows, weights, share, epochs, seed):
    def tree(leaves, budget, level):
        if level == 3:
            return {(): budget}
        groups = defaultdict(dict)
        for path, t in leaves.items():
            groups[path[0]][path[1:]] = t
        q = fill(budget, {k: (epochs * sum(v.values()), weights.get(M.LEVELS[level], {}).get(k, 1.0)) for k, v in groups.items()})
        return {(k, *p): x for k, v in groups.items() for p, x in tree(v, q[k], level + 1).items()}
    leaf = defaultdict(list)
    for i, t, *path in rows:
        leaf[tuple(p or M.NONE for p in path)].append(("" if i is None else str(i), -(-len((t or "").encode()) // 4), i))
    sizes = {p: sum(x[1] for x in v) for p, v in leaf.items()}
    out = []
    for p, quota in tree(sizes, share * sum(sizes.values()), 0).items():
        quota, t = int(quota + 1e-6), sizes[p]
        if not t or not quota:
            continue
        full, rest = divmod(quota, t)
        key = lambda x: (int(hashlib.md5(f"{seed}:{full}:{x[0]}".encode()).hexdigest()[:15], 16), x[0])
        units = defaultdict(list)
        for x in leaf[p]:
            units[key(x)].append(x)
        used = 0
        for u in sorted(units):
            n = full + (used < rest)
            used += sum(x[1] for x in units[u])
            out += [(x[2], e, x[1]) for x in units[u] for e in range(n)]
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [0.05, 0.7, 1.4, 9.0])
def test_against_brute_force(spark, share):
    rng = random.Random(8)
    rows = [(i, "x" * rng.randrange(0, 90), rng.choice(["a", "a", "b", None]), rng.choice(["en", "de"]),
             "hot" if rng.random() < 0.4 else f"s{rng.randrange(4)}") for i in range(400)]
    rows += [rows[3], rows[3], (None, "null id", "a", None, None), (None, "another", "a", None, None), (901, None, "b", "en", "empty"), (902, "", "zero", "en", "s1")]
    w = {"domain": {"a": 3.0, "b": 0.5, "zero": 0.0}, "lang": {"en": 2.0}}
    got = sorted(((r.doc_id, r.mix_epoch, r.mix_tokens) for r in M.mix(spark.createDataFrame(rows, S), w, share, 2, 5).collect()), key=str)
    assert got == brute(rows, w, share, 2, 5)


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "x", "s1", 10, 1), ("a", "x", "s2", 1000, 1), ("a", "y", "s1", 1000, 1), ("b", "x", "s1", 1000, 1)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint, docs bigint")
    q = {(r.domain, r.lang, r.source): r.quota for r in M.allocate(df, budget=800.0, max_epochs=1).collect()}
    assert q == {("a", "x", "s1"): 10, ("a", "x", "s2"): 190, ("a", "y", "s1"): 200, ("b", "x", "s1"): 400}


def test_empty_and_clashing_columns(spark):
    assert M.mix(spark.createDataFrame([], S)).count() == 0
    d = spark.createDataFrame([(1, "abcd", "d", "en", "s", 7, 8, 9)], S + ", tokens int, key int, mix_epoch int")
    r = M.mix(d, budget_share=2.0).collect()
    assert [(x.doc_id, x.mix_epoch, x.tokens, x.key) for x in r] == [(1, 0, 7, 8), (1, 1, 7, 8)] or len(r) == 2


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(QUERIES["op7_mixing"](spark, sf), duck(sf), ORACLES["op7_mixing"])
    assert r["match"] and r["rows"] > 300, r
