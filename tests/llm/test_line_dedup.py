import random
from collections import defaultdict

from tessera.llm import line_dedup as L
from tessera.llm.queries import ORACLES, QUERIES
from tessera.plans.check import compare, duck

S = "doc_id bigint, text string, source string"


def brute(rows, sites, least):
    key = lambda x: x.strip(" ")
    spread = defaultdict(set)
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if len(key(x).encode()) >= least and s is not None:
                spread[key(x)].add(s)
    bad = {x for x, s in spread.items() if len(s) >= sites}
    out = []
    for d, t, _ in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        lines = t.split("\n")
        kept = [x for x in lines if key(x) not in bad]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_against_brute_force(docs_of):
    rng = random.Random(1)
    pool = [f"line number {i} with some length" for i in range(60)] + ["short", "", "  padded line of some length  ", "padded line of some length"]
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 3, 8])
        src = "hot" if rng.random() < 0.35 else f"s{rng.randrange(40)}"
        rows.append((i, "\n".join(rng.choice(pool[: rng.choice([5, 30, 64])]) for _ in range(n)), src))
    rows += [(900, None, "s1"), (901, "", None), (902, pool[0] + "\n" + pool[40], None), rows[5], rows[5]]
    for sites in (3, 12, 25):
        got = sorted((tuple(r) for r in L.remove_boilerplate(docs_of(rows, S), sites).collect()), key=str)
        assert got == brute(rows, sites, L.LEAST_BYTES)


def test_null_id_and_empty(docs_of):
    rows = [(None, "the very same line here\nx", f"s{i}") for i in range(4)]
    got = L.remove_boilerplate(docs_of(rows, S), 3).collect()
    assert [tuple(r) for r in got] == [(None, 2, 1, "x")] * 4
    assert L.remove_boilerplate(docs_of([], S)).count() == 0


def test_wide_lines_use_estimates(docs_of):
    rows = [(i, "everywhere this one line\nown line of document %d" % i, f"site{i}") for i in range(600)]
    got = L.remove_boilerplate(docs_of(rows, S), 10).collect()
    assert {(r.n_lines, r.n_removed) for r in got} == {(2, 1)}


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(QUERIES["op6_line_dedup"](spark, sf), duck(sf), ORACLES["op6_line_dedup"])
    assert r["match"] and r["rows"] == 1000, r
