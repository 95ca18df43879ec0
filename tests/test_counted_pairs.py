"""Pairs of copies are counted from group sizes, as if they had been listed."""

from pyspark.sql import functions as F

from tessera.operators import lsh


def test_counts_equal_the_listed_pairs(spark):
    text = ["a b c d e f g h", "a b c d e f g i", "x y z u v w", "a b c d e f g h i j"]
    docs = [(i, text[0]) for i in range(40)] + [(i, text[1]) for i in range(40, 60)] + [(60, text[2]), (60, text[2]), (61, text[2]), (62, text[3]), (3, text[3]), (70, None), (71, " ")]
    sets = lsh.shingle(spark.createDataFrame(docs, "doc_id bigint, text string"), with_key=True)
    reps, rows = lsh.distinct_sets(sets)
    assert reps.count() == 4
    found = lsh.counted_pairs(lsh.exact_similar_pairs_from_sets(reps, 0.5, collapse=False), rows)
    got = {round(r.jaccard, 6): r.n for r in found.groupBy("jaccard").agg(F.sum("n").alias("n")).collect()}
    shingles = [(d, {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)}) for d, t in docs if t and t.strip()]
    want = {}
    for k, (a, s) in enumerate(shingles):
        for b, t in shingles[:k]:
            j = len(s & t) / len(s | t)
            if a != b and j >= 0.5:
                want[round(j, 6)] = want.get(round(j, 6), 0) + 1
    assert got == want
    assert found.count() <= 4 + 6                          # one row for each content and pair of contents
