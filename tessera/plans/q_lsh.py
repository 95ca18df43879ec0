"""Near-duplicate queries over ``documents`` / ``benchmark``."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import shingle_ids, words
from tessera.operators import lsh, pair_scoring
from tessera.operators.mapreduce import map_reduce
from tessera.plans.registry import query, table
from tessera.session import checkpoint_dir, materialize, materialize_sets
from tessera.sources.parallel import spread
from tessera.plans.sqlparts import (band_ctes, groups_ctes, minhash_ctes, near_dup_edges_ctes, r6,
                                    shingles_cte)
from tessera.sources.lines import parse_shingle_lines, read_pairs, shingle_lines

R, B, SEED, T85 = lsh.DEFAULT_R, lsh.DEFAULT_B, lsh.DEFAULT_SEED, lsh.DEFAULT_THRESHOLD


def _r6(c):
    return (F.round(c.cast("double"), 6) + F.lit(0.0))


def _sets(spark, sf):
    return materialize_sets(lsh.shingle(table(spark, sf, "documents"), with_key=True))


def _reps(spark, sf):
    """Shingle sets of one document for each distinct content (copies are no pairs)."""
    sets = _sets(spark, sf)
    reps = materialize_sets(lsh.collapse_identical(sets)[0])
    sets.unpersist()  # the representatives are kept
    return reps


# ---------------------------------------------------------------- D2 word count
WORD_COUNT_SQL = """
SELECT word, count(*)::BIGINT AS cnt FROM (
  SELECT unnest(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS word
  FROM documents WHERE text IS NOT NULL) GROUP BY word"""


@query("word_count", WORD_COUNT_SQL)
def word_count(spark, sf):
    """Split every text on whitespace (case kept), count per word."""
    d = spread(table(spark, sf, "documents").select("text"))
    w = d.select(F.explode(words(F.col("text"), lower=False)).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query("map_reduce_word_count", WORD_COUNT_SQL)
def map_reduce_word_count(spark, sf):
    """H2: the reference's sample job through the user map-reduce API (with combiner)."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull()).select(F.col("text").alias("value"))

    def mapper(_, line):
        for tok in line.split():
            yield tok, 1

    def summer(k, values):
        yield k, sum(values)

    return map_reduce(d, mapper, summer, T.StringType(), T.LongType(),
                      "word string, cnt bigint", combiner=summer)


# ---------------------------------------------------------------- G2 / A2
SHINGLE_SQL = f"""WITH {shingles_cte()}
SELECT doc_id, len(s)::BIGINT AS n_shingles, list_sum(list_transform(s, lambda x: x % 2147483647))::BIGINT AS sum_ids,
       list_min(s) AS min_id, list_max(s) AS max_id FROM sh"""


@query("shingle_documents", SHINGLE_SQL)
def shingle_documents(spark, sf):
    """3-word shingle id sets per document (summarised per doc)."""
    s = lsh.shingle(table(spark, sf, "documents"))
    return s.select("doc_id", F.size("shingles").cast("bigint").alias("n_shingles"),
                    F.aggregate("shingles", F.lit(0).cast("bigint"), lambda a, x: a + x % 2147483647).alias("sum_ids"),
                    F.array_min("shingles").alias("min_id"), F.array_max("shingles").alias("max_id"))


@query("parse_shingle_lines", f"""WITH {shingles_cte()}
SELECT doc_id, len(s)::BIGINT AS n_shingles, list_sum(list_transform(s, lambda x: x % 2147483647))::BIGINT AS sum_ids FROM sh""")
def parse_shingle_lines_q(spark, sf):
    """A2: 'PAGE_<id> <sid> ...' lines (written from the shingle table) parsed back."""
    lines = shingle_lines(lsh.shingle(table(spark, sf, "documents")))
    p = parse_shingle_lines(lines)
    return p.select("doc_id", F.size("shingles").cast("bigint").alias("n_shingles"),
                    F.aggregate("shingles", F.lit(0).cast("bigint"), lambda a, x: a + x % 2147483647).alias("sum_ids"))


# ---------------------------------------------------------------- D3 / H1 / B8
@query("minhash_signature", f"""WITH {shingles_cte()}, {minhash_ctes(R * B, SEED)}
SELECT doc_id, h::INTEGER AS h, v::BIGINT AS v FROM sig""")
def minhash_signature(spark, sf):
    """D3/H1: MinHash signature (100 hashes) per document, long form (doc_id, h, v)."""
    sig = lsh.minhash(_sets(spark, sf), R * B, SEED)
    return sig.select("doc_id", F.posexplode("sig").alias("h", "v"))


@query("band_rows", f"""WITH {shingles_cte()}, {minhash_ctes(R * B, SEED)}, {band_ctes(R, B, SEED)}
SELECT doc_id, band, key FROM bnd""")
def band_rows(spark, sf):
    """One row per (document, band) with the band hash key."""
    return lsh.bands(lsh.minhash(_sets(spark, sf), R * B, SEED), R, B, SEED)


_CAND_SQL = f"""{shingles_cte()}, {groups_ctes()}, {minhash_ctes(R * B, SEED, sets='grp_reps')}, {band_ctes(R, B, SEED)},
cand AS (SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b
         FROM bnd a JOIN bnd b ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id),
ver AS (SELECT c.doc_a, c.doc_b,
               len(list_intersect(x.s, y.s)) / (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s))) AS j
        FROM cand c JOIN grp_reps x ON x.doc_id = c.doc_a JOIN grp_reps y ON y.doc_id = c.doc_b)"""


@query("lsh_candidate_pairs", f"WITH {_CAND_SQL} SELECT doc_a, doc_b FROM cand")
def lsh_candidate_pairs(spark, sf):
    """Distinct pairs of different texts sharing a band bucket (skew-tiled self-join)."""
    b = lsh.bands(lsh.minhash(_reps(spark, sf), R * B, SEED), R, B, SEED)
    return lsh.candidate_pairs(b)


@query("pair_verify_join", f"WITH {_CAND_SQL} SELECT doc_a, doc_b, {r6('j')} AS jaccard FROM ver")
def pair_verify_join(spark, sf):
    """Exact Jaccard of every candidate pair via two joins on doc id."""
    sets = _reps(spark, sf)
    c = lsh.candidate_pairs(lsh.bands(lsh.minhash(sets, R * B, SEED), R, B, SEED))
    v = lsh.verify_pairs(c, sets)
    return v.select("doc_a", "doc_b", _r6(F.col("jaccard")).alias("jaccard"))


@query("jaccard_threshold_filter",
       f"WITH {_CAND_SQL} SELECT doc_a, doc_b, {r6('j')} AS jaccard FROM ver WHERE j >= 0.7")
def jaccard_threshold_filter(spark, sf):
    """B1: verified candidates with Jaccard >= 0.7 (inclusive)."""
    sets = _reps(spark, sf)
    c = lsh.candidate_pairs(lsh.bands(lsh.minhash(sets, R * B, SEED), R, B, SEED))
    v = lsh.threshold_filter(lsh.verify_pairs(c, sets), 0.7)
    return v.select("doc_a", "doc_b", _r6(F.col("jaccard")).alias("jaccard"))


# ---------------------------------------------------------------- L1 flagship
NEAR_DUP_SQL = f"WITH {near_dup_edges_ctes(T85)} SELECT doc_a, doc_b, {r6('j')} AS jaccard FROM nd"


def near_dup_pairs_sf(spark, sf):
    p = lsh.near_dup_pairs(table(spark, sf, "documents"), 3, R, B, T85, SEED)
    return p.select("doc_a", "doc_b", _r6(F.col("jaccard")).alias("jaccard"))


@query("near_dup_pairs", NEAR_DUP_SQL)
def near_dup_pairs(spark, sf):
    """L1 (flagship): MinHash + banded LSH + exact Jaccard >= 0.85, compressed edge form."""
    return near_dup_pairs_sf(spark, sf)


@query("exact_similar_pairs", NEAR_DUP_SQL)
def exact_similar_pairs(spark, sf):
    """C7 for sets: exact Jaccard >= 0.85 self-join by prefix filtering (no LSH)."""
    p = lsh.exact_similar_pairs(table(spark, sf, "documents"), 3, T85)
    return p.select("doc_a", "doc_b", _r6(F.col("jaccard")).alias("jaccard"))


# ---------------------------------------------------------------- L2 / D4 / C6
TRUTH_WORDS = 10


def _openings(spark, sf):
    """``doc_id, group``: documents by their first ten words (the truth of the scoring
    queries, which knows nothing of shingles)."""
    d = spread(table(spark, sf, "documents").select("doc_id", "text"))
    # only the opening is split into words, not the whole text
    opening = F.regexp_extract(F.lower("text"), rf"^\s*+((?:\S++\s++){{0,{TRUTH_WORDS - 1}}}\S++)", 1)
    return (d.select("doc_id", opening.alias("o")).where("doc_id IS NOT NULL AND o <> ''")
            .select("doc_id", F.array_join(F.split("o", r"\s+"), " ").alias("group")).distinct())


def _truth_pairs(spark, sf):
    """A3: each document and the first one that opens alike, written as a truth file ``a,b`` and read back."""
    g = _openings(spark, sf)
    first = g.groupBy("group").agg(F.min("doc_id").alias("first"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/truth-{uuid.uuid4().hex}"
    g.join(first, "group").where("first <> doc_id").select("first", "doc_id").write.csv(path)
    return read_pairs(spark, path)


_TRUTH_SQL = f"""
op AS (SELECT DISTINCT doc_id, array_to_string(w[1:{TRUTH_WORDS}], ' ') AS k FROM sh_w WHERE len(w) > 0 AND doc_id IS NOT NULL),
op1 AS (SELECT k, min(doc_id) AS f FROM op GROUP BY k)"""


def _expanded_sql(edges, name):
    """All pairs of documents that the compressed links ``edges(doc_a, doc_b)`` and the groups stand for."""
    return f"""{name} AS (
  SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM grp a JOIN grp b ON a.rep = b.rep AND a.doc_id < b.doc_id
  UNION SELECT least(a.doc_id, b.doc_id), greatest(a.doc_id, b.doc_id) FROM {edges} e JOIN grp a ON a.rep = e.doc_a JOIN grp b ON b.rep = e.doc_b)"""


def _f1_sql(reported, truth):
    return f"""
fo AS (SELECT l.doc_a IS NOT NULL AS r, t.doc_a IS NOT NULL AS t
       FROM {reported} l FULL OUTER JOIN {truth} t ON l.doc_a = t.doc_a AND l.doc_b = t.doc_b),
c AS (SELECT coalesce(sum(CASE WHEN r AND t THEN 1 ELSE 0 END), 0)::BIGINT AS tp,
             coalesce(sum(CASE WHEN r AND NOT t THEN 1 ELSE 0 END), 0)::BIGINT AS fp,
             coalesce(sum(CASE WHEN t AND NOT r THEN 1 ELSE 0 END), 0)::BIGINT AS fn FROM fo),
pr AS (SELECT tp, fp, fn,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM c)
SELECT tp, fp, fn, {r6('p')} AS precision, {r6('rc')} AS recall,
       {r6('CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0.0 END')} AS f1 FROM pr"""


def _rounded(f):
    return f.select("tp", "fp", "fn", *[_r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def _detected(spark, sf, r=R, b=B):
    """(representative sets, edges to their copies, content groups, compressed edges) of the flagship detector."""
    sets = _sets(spark, sf)
    members = materialize(lsh.content_groups(sets.where(F.size("shingles") > 0)))
    reps, star = lsh.collapse_identical(sets)
    reps = materialize_sets(reps)
    sets.unpersist()  # the representatives are kept
    return reps, star, members, lsh.near_dup_pairs_from_sets(reps, r, b, T85, SEED, collapse=False).unionByName(star)


_PAIRS_SQL = f"""WITH {near_dup_edges_ctes(T85)}, {_expanded_sql('ex', 'rep')}, {_TRUTH_SQL},
tru AS (SELECT DISTINCT f AS doc_a, doc_id AS doc_b FROM op JOIN op1 USING (k) WHERE f <> doc_id)"""


@query("near_dup_f1", f"{_PAIRS_SQL}, {_f1_sql('rep', 'tru')}")
def near_dup_f1(spark, sf):
    """L2/A3: every pair of documents that the LSH edges stand for, scored against a truth file."""
    *_, members, edges = _detected(spark, sf)
    return _rounded(pair_scoring.f1_of_pairs(edges, members, _truth_pairs(spark, sf)))


@query("near_dup_group_f1", f"""WITH {near_dup_edges_ctes(T85)}, {_expanded_sql('ex', 'rep')}, {_TRUTH_SQL},
tru AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM op a JOIN op b ON a.k = b.k AND a.doc_id < b.doc_id), {_f1_sql('rep', 'tru')}""")
def near_dup_group_f1(spark, sf):
    """L2: the same pairs scored against true groups (all documents that open alike)."""
    *_, members, edges = _detected(spark, sf)
    return _rounded(pair_scoring.f1_of_groups(edges, members, _openings(spark, sf)))


@query("dup_pair_confusion", f"""{_PAIRS_SQL},
lab AS (SELECT coalesce(l.doc_a, t.doc_a) AS a, coalesce(l.doc_b, t.doc_b) AS b,
               CASE WHEN t.doc_a IS NULL THEN 'fp' WHEN l.doc_a IS NULL THEN 'fn' ELSE 'tp' END AS kind
        FROM rep l FULL OUTER JOIN tru t ON l.doc_a = t.doc_a AND l.doc_b = t.doc_b)
SELECT least(coalesce(x.rep, a), coalesce(y.rep, b)) AS rep_a, greatest(coalesce(x.rep, a), coalesce(y.rep, b)) AS rep_b, kind, count(*) AS n_pairs
FROM lab LEFT JOIN grp x ON x.doc_id = a LEFT JOIN grp y ON y.doc_id = b GROUP BY ALL""")
def dup_pair_confusion(spark, sf):
    """True, false and missed pairs, counted by pair of content groups."""
    *_, members, edges = _detected(spark, sf)
    return pair_scoring.confusion(edges, members, _truth_pairs(spark, sf))


# ---------------------------------------------------------------- D4 with misses
F1_R, F1_B = 10, 5  # short on bands on purpose: (1 - 0.85^10)^5 = 0.33 miss rate at t


def _lsh_links_sql(r, b, t):
    return f"""{minhash_ctes(r * b, SEED, sets='grp_reps')}, {band_ctes(r, b, SEED)},
cand AS (SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM bnd a JOIN bnd b
         ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id),
lk AS (SELECT c.doc_a, c.doc_b FROM cand c JOIN grp_reps x ON x.doc_id = c.doc_a JOIN grp_reps y ON y.doc_id = c.doc_b
       WHERE len(list_intersect(x.s, y.s)) / (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s))) >= {t})"""


@query("dedup_f1", f"""WITH {near_dup_edges_ctes(T85)}, {_lsh_links_sql(F1_R, F1_B, T85)},
{_expanded_sql('lk', 'rep')}, {_expanded_sql('ex', 'tru')}, {_f1_sql('rep', 'tru')}""")
def dedup_f1(spark, sf):
    """All pairs of a deliberately short-banded LSH (r=10, b=5) scored against the exact join's."""
    reps, star, members, edges = _detected(spark, sf, F1_R, F1_B)
    true = lsh.exact_similar_pairs_from_sets(reps, T85, collapse=False).unionByName(star)
    return _rounded(pair_scoring.f1_of_edges(edges, members, true))


# ---------------------------------------------------------------- L3
@query("dedup_keep_first", f"""WITH RECURSIVE {near_dup_edges_ctes(T85)},
e AS (SELECT doc_a AS u, doc_b AS v FROM nd UNION SELECT doc_b, doc_a FROM nd),
reach(s, t) AS (SELECT u, u FROM e UNION SELECT r.s, e.v FROM reach r JOIN e ON r.t = e.u),
g AS (SELECT s AS doc_id, min(t) AS group_id FROM reach GROUP BY s)
SELECT doc_id, coalesce(group_id, doc_id) AS group_id, coalesce(group_id, doc_id) = doc_id AS keep
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN g USING (doc_id)""")
def dedup_keep_first(spark, sf):
    """L3: connected near-duplicate groups for all documents; keep the lowest id."""
    return lsh.dedup_keep_first(table(spark, sf, "documents"), 3, T85, R, B, SEED)


# ---------------------------------------------------------------- cross-set
CONTAM_T = 0.9


@query("contamination_pairs", f"""WITH {shingles_cte(name='sh')},
{shingles_cte(table='benchmark', id_col='item_id', name='bm')},
inv AS (SELECT doc_id, unnest(s) AS e FROM sh), binv AS (SELECT doc_id AS item_id, len(s) AS n, unnest(s) AS e FROM bm)
SELECT item_id, doc_id, {r6('count(*) / any_value(n)')} AS containment FROM binv JOIN inv USING (e)
GROUP BY item_id, doc_id HAVING count(*) / any_value(n) >= {CONTAM_T}""")
def contamination_pairs(spark, sf):
    """Benchmark items of which a document holds at least 0.9 of the shingles."""
    bm = lsh.shingle(table(spark, sf, "benchmark"), id_col="item_id")
    p = lsh.containment_pairs(bm, _sets(spark, sf), CONTAM_T)
    return p.select("item_id", "doc_id", _r6(F.col("containment")).alias("containment"))


__all__ = ["near_dup_pairs_sf", "shingle_ids", "groups_ctes"]
