from tessera.llm import line_dedup as L
from tessera.llm.queries import ORACLES, QUERIES
from tessera.plans.check import compare, duck


def test_short_lines_are_judged_and_blank_lines_stay(docs_of):
    rows = [(i, f"Read more\nown {i}\n\n\t\n \nx", f"s{i % 12}") for i in range(24)]
    got = L.remove_boilerplate(docs_of(rows, "doc_id bigint, text string, source string"), 10, least_bytes=1).collect()
    assert {r.doc_id: (r.n_removed, r.kept_text) for r in got} == {i: (2, f"own {i}\n\n\t\n ") for i in range(24)}


def test_query_removes_more_than_long_lines(spark):
    sf, name = "/root/testdata/sf0.01", "op6_line_dedup_every_line"
    r = compare(QUERIES[name](spark, sf), duck(sf), ORACLES[name])
    assert r["match"] and r["rows"] == 1000, r
    gone = lambda q: q(spark, sf).agg({"n_removed": "sum"}).first()[0]
    assert gone(QUERIES[name]) > gone(QUERIES["op6_line_dedup"])
