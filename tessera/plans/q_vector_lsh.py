"""Vector LSH, distance joins, collision curves and edit distance queries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tessera.operators import lsh
from tessera.operators import metric_join
from tessera.operators import vector_lsh as VL
from tessera.plans.q_cluster import PTS, label_centers, points
from tessera.plans.registry import query, table
from tessera.session import materialize, materialize_sets
from tessera.sources import lines
from tessera.plans.sqlparts import band_ctes, exact_pairs_ctes, minhash_ctes, r6, shingles_cte
from tessera.plans.sqlparts import gaussian as sql_gaussian
from tessera.plans.sqlparts import uniform as sql_uniform

SEED = 7


def _r6(c):
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def _pts(spark, sf):
    return materialize(lines.points(table(spark, sf, "embeddings"), "vec_id", "embedding"))


def _w_cte(name: str, tag: str, n: int, normalise: bool) -> str:
    base = f"""
{name}_g AS (SELECT k, j, {sql_gaussian(f"'{SEED}:{tag}:' || k || ':' || j")} AS w
             FROM range({n}) a(k), range(64) b(j))"""
    if not normalise:
        return base + f",\n{name} AS (SELECT k, j, w FROM {name}_g)"
    return base + f""",
{name}_n AS (SELECT k, sqrt(sum(w * w)) AS nrm FROM {name}_g GROUP BY k),
{name} AS (SELECT g.k, g.j, g.w / n.nrm AS w FROM {name}_g g JOIN {name}_n n USING (k))"""


def _dots(name: str, W: str, src: str = "pl") -> str:
    return f"""
{name} AS (SELECT p.id, w.k, sum(p.v * w.w) AS dt FROM {src} p JOIN {W} w ON w.j = p.j GROUP BY p.id, w.k)"""


def _bands_cte(name: str, vals: str, valexpr: str, r: int) -> str:
    return f"""
{name} AS (SELECT id, (k // {r})::INTEGER AS band, string_agg(({valexpr})::VARCHAR, ',' ORDER BY k) AS key
           FROM {vals} GROUP BY id, k // {r})"""


def _pairs_cte(name: str, bands: str) -> str:
    return f"""
{name} AS (SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM {bands} a JOIN {bands} b
           ON a.band = b.band AND a.key = b.key AND a.id < b.id)"""


def _metric_cte(name: str, pairs: str) -> str:
    return f"""
{name} AS (SELECT c.id_a, c.id_b, sum(a.v * b.v) AS dt, sum(a.v * a.v) AS na, sum(b.v * b.v) AS nb,
                  sum((a.v - b.v) * (a.v - b.v)) AS d2
           FROM {pairs} c JOIN pl a ON a.id = c.id_a JOIN pl b ON b.id = c.id_b AND b.j = a.j
           GROUP BY c.id_a, c.id_b)"""


# ---------------------------------------------------------------- L4
RECALL = 0.95  # of a pair just at the threshold
COS_R, COS_T = 6, 0.4
COS_B = VL.bands_for_recall(VL.cosine_agreement(COS_T), COS_R, RECALL)


@query("cosine_lsh_pairs", f"""WITH {PTS}, {_w_cte('W', 'cos', COS_R * COS_B, False)}, {_dots('dt', 'W')},
{_bands_cte('bd', 'dt', 'CASE WHEN dt >= 0 THEN 1 ELSE 0 END', COS_R)}, {_pairs_cte('cp', 'bd')},
{_metric_cte('m', 'cp')}
SELECT id_a, id_b, {r6('dt / (sqrt(na) * sqrt(nb))')} AS cosine FROM m WHERE dt / (sqrt(na) * sqrt(nb)) >= {COS_T}""")
def cosine_lsh_pairs(spark, sf):
    """L4: random-hyperplane LSH (bands of 6 bits for a recall of 0.95), verified cosine >= 0.4."""
    p = VL.cosine_lsh_pairs(_pts(spark, sf), COS_R, COS_B, COS_T, SEED)
    return p.select("id_a", "id_b", _r6(F.col("cosine")).alias("cosine"))


# ---------------------------------------------------------------- L5 / L6
# projections of unit vectors spread 1/8: cells of two deviations
E_R, E_A = 4, 0.25
E_RAD = 1.1
E_B = VL.bands_for_recall(VL.euclidean_agreement(E_RAD, E_A, 64), E_R, RECALL)
E2 = f"""{_w_cte('W2', 'e2', E_R * E_B, True)},
bb AS (SELECT k, {E_A} * {sql_uniform(f"'{SEED}:e2b:' || k")} AS b FROM range({E_R * E_B}) a(k))"""


def _hash_expr() -> str:
    return f"floor((dt + (SELECT b FROM bb WHERE bb.k = h.k)) / {E_A})::BIGINT"


@query("euclidean_lsh_pairs", f"""WITH {PTS}, {E2}, {_dots('h', 'W2')},
{_bands_cte('bd', 'h', _hash_expr(), E_R)}, {_pairs_cte('cp', 'bd')}, {_metric_cte('m', 'cp')}
SELECT id_a, id_b, {r6('sqrt(d2)')} AS l2 FROM m WHERE sqrt(d2) <= {E_RAD}""")
def euclidean_lsh_pairs(spark, sf):
    """P-stable LSH floor((w.x+b)/a) (bands of 4 for a recall of 0.95), verified l2 <= 1.1."""
    p = VL.euclidean_lsh_pairs(_pts(spark, sf), E_R, E_B, E_A, E_RAD, SEED)
    return p.select("id_a", "id_b", _r6(F.col("l2")).alias("l2"))


NN_RAD = 0.95


@query("near_neighbors", f"""WITH {PTS}, {E2},
qv AS (SELECT cid AS id, j, v FROM cen), {_dots('h', 'W2')}, {_dots('hq', 'W2', 'qv')},
{_bands_cte('bd', 'h', _hash_expr(), E_R)},
{_bands_cte('bq', 'hq h', _hash_expr(), E_R)},
cp AS (SELECT DISTINCT q.id AS qid, b.id FROM bq q JOIN bd b ON q.band = b.band AND q.key = b.key),
m AS (SELECT c.qid, c.id, sum((q.v - p.v) * (q.v - p.v)) AS d2 FROM cp c
      JOIN qv q ON q.id = c.qid JOIN pl p ON p.id = c.id AND p.j = q.j GROUP BY c.qid, c.id)
SELECT qid, id, {r6('sqrt(d2)')} AS l2 FROM m WHERE sqrt(d2) <= {NN_RAD}""")
def near_neighbors(spark, sf):
    """Points within 0.95 of each label centre via shared E2LSH buckets."""
    pts = _pts(spark, sf)
    cids, C = label_centers(points(spark, sf))
    q = spark.createDataFrame([(int(c), [float(v) for v in row]) for c, row in zip(cids, C)],
                              "id bigint, x array<double>")
    r = VL.near_neighbors(q, pts, E_R, E_B, E_A, NN_RAD, SEED)
    return r.select("qid", "id", _r6(F.col("l2")).alias("l2"))


# ---------------------------------------------------------------- L7
HP_T = 4


@query("hyperplane_lsh", f"""WITH {PTS},
wq AS (SELECT j, sum(CASE WHEN p.label < 5 THEN 1.0 ELSE -1.0 END * p.v) / (SELECT count(*) FROM embeddings) AS w
       FROM pl p GROUP BY j),
{_w_cte('U', 'hu', HP_T, False)}, {_w_cte('V', 'hv', HP_T, False)},
qu AS (SELECT U.k, CASE WHEN sum(U.w * wq.w) >= 0 THEN 1 ELSE 0 END AS b FROM U JOIN wq USING (j) GROUP BY U.k),
qvv AS (SELECT V.k, 1 - CASE WHEN sum(V.w * wq.w) >= 0 THEN 1 ELSE 0 END AS b FROM V JOIN wq USING (j) GROUP BY V.k),
{_dots('pu', 'U')}, {_dots('pv', 'V')},
hit AS (SELECT DISTINCT pu.id FROM pu JOIN pv ON pv.id = pu.id AND pv.k = pu.k
        JOIN qu ON qu.k = pu.k JOIN qvv ON qvv.k = pu.k
        WHERE (CASE WHEN pu.dt >= 0 THEN 1 ELSE 0 END) = qu.b AND (CASE WHEN pv.dt >= 0 THEN 1 ELSE 0 END) = qvv.b),
sc AS (SELECT p.id, sum(p.v * wq.w) AS score FROM pl p JOIN wq USING (j) JOIN hit USING (id) GROUP BY p.id)
SELECT id, {r6('score')} AS score FROM sc ORDER BY abs(score), id LIMIT 20""")
def hyperplane_lsh(spark, sf):
    """2-bit hyperplane hashes (4 tables) prefilter, then the 20 points nearest the boundary."""
    import numpy as np
    from tessera.operators import linear as L
    pts = points(spark, sf)
    lab = pts.select("id", "x", F.when(F.col("label") < 5, 1.0).otherwise(-1.0).alias("y"))
    s, n = L.vector_sum(lab, "raw", coef="y")
    w = s / n
    cand = VL.hyperplane_lsh_candidates(lab, np.asarray(w), HP_T, SEED)
    scored = L.svm_score(cand, w)
    return L.uncertainty_topm(scored, 20).select("id", _r6(F.col("score")).alias("score"))


# ---------------------------------------------------------------- C7
EPS = 1.05


@query("pairwise_distance_join", f"""WITH {PTS},
pr AS (SELECT a.id AS id_a, b.id AS id_b FROM pts a JOIN pts b ON a.id < b.id),
{_metric_cte('m', 'pr')}
SELECT id_a, id_b, {r6('sqrt(d2)')} AS l2 FROM m WHERE sqrt(d2) <= {EPS}""")
def pairwise_distance_join(spark, sf):
    """Exact epsilon-join (l2 <= 1.05) by metric pivots."""
    p = metric_join.distance_join(_pts(spark, sf), EPS, seed=SEED)
    return p.select("id_a", "id_b", _r6(F.col("l2")).alias("l2"))


@query("range_neighbors", f"""WITH {PTS},
m AS (SELECT c.cid AS qid, p.id, sum((c.v - p.v) * (c.v - p.v)) AS d2 FROM cen c JOIN pl p ON p.j = c.j GROUP BY c.cid, p.id)
SELECT qid::BIGINT AS qid, id, {r6('sqrt(d2)')} AS l2 FROM m WHERE sqrt(d2) <= {NN_RAD}""")
def range_neighbors(spark, sf):
    """All points within 0.95 of each label centre, exactly, by metric pivots."""
    cids, C = label_centers(points(spark, sf))
    q = spark.createDataFrame([(int(c), [float(v) for v in row]) for c, row in zip(cids, C)], "id bigint, x array<double>")
    r = metric_join.range_neighbors(q, _pts(spark, sf), NN_RAD, seed=SEED)
    return r.select("qid", "id", _r6(F.col("l2")).alias("l2"))


# ---------------------------------------------------------------- G6
CURVE_T = 0.5
R, B, LSEED = lsh.DEFAULT_R, lsh.DEFAULT_B, lsh.DEFAULT_SEED


@query("lsh_collision_curve", f"""WITH {shingles_cte()}, {exact_pairs_ctes(CURVE_T, sets='sh')},
{minhash_ctes(R * B, LSEED)},
{band_ctes(R, B, LSEED)},
cand AS (SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM bnd a JOIN bnd b
         ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id),
o AS (SELECT ex.j, (c.doc_a IS NOT NULL)::INTEGER AS hit FROM ex LEFT JOIN cand c USING (doc_a, doc_b))
SELECT (floor(j * 10) / 10) AS bucket, count(*) AS n_pairs, {r6('avg(hit)')} AS observed,
       {r6(f'avg(1 - pow(1 - pow(j, {R}), {B}))')} AS predicted FROM o GROUP BY 1""")
def lsh_collision_curve(spark, sf):
    """1-(1-s^r)^b against the observed candidate rate per similarity bucket (exact pairs >= 0.5)."""
    sets, rows = _distinct(spark, sf)
    ex = lsh.counted_pairs(lsh.exact_similar_pairs_from_sets(sets, CURVE_T, collapse=False, kept=True), rows)
    cand = lsh.candidate_pairs(lsh.bands(lsh.minhash(sets, R * B, LSEED), R, B, LSEED)).withColumn("hit", F.lit(1))
    o = ex.join(cand, ["doc_a", "doc_b"], "left")
    # copies have one signature
    o = o.withColumn("hit", F.when(F.col("doc_a") == F.col("doc_b"), 1).otherwise(F.coalesce("hit", F.lit(0))))
    o = o.withColumn("bucket", F.floor(F.col("jaccard") * 10) / 10)
    return o.groupBy("bucket").agg(F.sum("n").alias("n_pairs"), _weighted(F.col("hit")).alias("observed"),
                                   _weighted(VL.collision_probability(F.col("jaccard"), R, B)).alias("predicted"))


def _distinct(spark, sf):
    """(sets of the distinct contents, rows of their documents)."""
    return lsh.distinct_sets(materialize_sets(lsh.shingle(table(spark, sf, "documents"), with_key=True)))


def _weighted(c):
    """Mean over all pairs of rows."""
    return _r6(F.sum(c * F.col("n")) / F.sum("n"))


CASCADE_R, CASCADE_B = 5, 20


@query("lsh_cascades", f"""WITH {shingles_cte()}, {exact_pairs_ctes(CURVE_T, sets='sh')}
SELECT (floor(j * 10) / 10) AS bucket, count(*) AS n_pairs, {r6(f'avg(1 - pow(1 - pow(j, {CASCADE_R}), {CASCADE_B}))')} AS and_or,
       {r6(f'avg(pow(1 - pow(1 - j, {CASCADE_B}), {CASCADE_R}))')} AS or_and FROM ex GROUP BY 1""")
def lsh_cascades(spark, sf):
    """Chance that an AND-OR and an OR-AND cascade of MinHash functions makes a pair a candidate, by similarity."""
    sets, rows = _distinct(spark, sf)
    ex = lsh.counted_pairs(lsh.exact_similar_pairs_from_sets(sets, CURVE_T, collapse=False, kept=True), rows)
    p = lambda *stages: _weighted(VL.cascade_probability(F.col("jaccard"), list(stages)))
    return ex.groupBy((F.floor(F.col("jaccard") * 10) / 10).alias("bucket")).agg(
        F.sum("n").alias("n_pairs"), p(("and", CASCADE_R), ("or", CASCADE_B)).alias("and_or"),
        p(("or", CASCADE_B), ("and", CASCADE_R)).alias("or_and"))


# ---------------------------------------------------------------- G5
@query("edit_distance")
def edit_distance(spark, sf):
    """Character edit distance between consecutive turns of each conversation (whole texts)."""
    c = table(spark, sf, "conversations")
    a = c.select("conv_id", F.col("turn").alias("t0"), F.col("text").alias("a"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("t0"), F.col("text").alias("b"))
    j = a.join(b, ["conv_id", "t0"])
    return j.select("conv_id", F.col("t0").alias("turn"), F.levenshtein("a", "b").alias("edits"),
                    F.length("a").alias("len_a"), F.length("b").alias("len_b"))
