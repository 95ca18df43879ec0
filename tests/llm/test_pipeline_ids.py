import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_one_row_of_each_component_under_repeated_ids(docs_of, spark):
    a, b, c, d, e = ("some words of text %s and what else it says about the thing %s" % (k * 3, k) for k in "pqxyz")
    rows = [(3, a), (5, b), (5, a), (7, c), (7, c.upper()), (7, c), (9, d), (9, e), (11, e)]
    got = sorted((r.doc_id, r.text.lower()) for r in P.drop_near_duplicates(spark, docs_of(rows), SF).collect())
    assert got == sorted([(3, a), (5, b), (7, c), (9, d), (9, e)])
