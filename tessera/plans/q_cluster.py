"""Clustering queries over ``embeddings`` (64-d unit vectors, labels 0-9).

Fixed model for the exact checks: the centres are the per-label means
(cid = label), computed from the table itself by both engines.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import cluster as K
from tessera.operators.mahalanobis import mahalanobis, whitening
from tessera.operators.partial import mean_by_key
from tessera.operators.sampling import uniform_sample, weighted_sample
from tessera.plans.registry import query, table
from tessera.plans.sqlparts import r6, uniform

SEED = 7
NS = 50  # sample size


def _r6(c):
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def points(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"),
                    F.col("label"))


def label_centers(pts):
    means = mean_by_key(pts, "label", cells=1 << 10)
    return np.array([k for k, _, _ in means], dtype=np.int32), np.array([m for _, _, m in means])


# ---------------------------------------------------------------- SQL parts
PTS = """
pts AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings),
pl AS (SELECT id, label, generate_subscripts(x, 1) - 1 AS j, unnest(x) AS v FROM pts),
cen AS (SELECT label AS cid, j, avg(v) AS v FROM pl GROUP BY label, j)"""


def assign_cte(name: str, centers: str) -> str:
    """``name(id, cid, d2)``: nearest centre, lowest cid on ties."""
    return f"""
{name}_d AS (SELECT p.id, c.cid, sum((p.v - c.v) * (p.v - c.v)) AS d2
             FROM pl p JOIN {centers} c ON c.j = p.j GROUP BY p.id, c.cid),
{name} AS (SELECT id, cid, d2 FROM {name}_d
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY d2, cid) = 1)"""


ASSIGN = PTS + "," + assign_cte("asg", "cen")


def sample_sql(src: str, wexpr: str, n: int, seed: int, tag: str, name: str = "smp") -> str:
    """E2 race in SQL: n smallest -ln(u)/w; unbiased weight from the (n+1)-th key."""
    return f"""
{name}_k AS (SELECT *, {wexpr} AS _w, -ln({uniform(f"'{seed}:{tag}:' || id")}) / ({wexpr}) AS _key
             FROM {src} WHERE {wexpr} > 0),
{name}_tot AS (SELECT sum(_w) AS tot FROM {name}_k),
{name}_r AS (SELECT *, row_number() OVER (ORDER BY _key, id) AS _rn FROM {name}_k),
{name}_tau AS (SELECT max(_key) AS tau, count(*) AS c FROM {name}_r WHERE _rn = {n + 1}),
{name} AS (SELECT r.*, r._w / t.tot AS p,
                  CASE WHEN (SELECT c FROM {name}_tau) = 0 THEN 1.0
                       ELSE 1.0 / (1.0 - exp(-r._w * (SELECT tau FROM {name}_tau))) END AS weight
           FROM {name}_r r, {name}_tot t WHERE _rn <= {n})"""


# ---------------------------------------------------------------- G4
@query("vector_distances", f"""WITH {PTS},
var AS (SELECT j, var_pop(v) AS var FROM pl GROUP BY j),
d AS (SELECT p.id, sum(abs(p.v - c.v)) AS l1, sum((p.v - c.v) * (p.v - c.v)) AS l2sq,
             max(abs(p.v - c.v)) AS linf, sum(pow(abs(p.v - c.v), 3)) AS l3c,
             sum(p.v * c.v) AS dt, sum(p.v * p.v) AS np, sum(c.v * c.v) AS nc,
             sum((p.v - c.v) * (p.v - c.v) / var.var) AS mh
      FROM pl p JOIN cen c ON c.cid = p.label AND c.j = p.j JOIN var ON var.j = p.j GROUP BY p.id),
e AS (SELECT *, CASE WHEN np * nc > 0 THEN dt / (sqrt(np) * sqrt(nc)) ELSE 0.0 END AS cs FROM d)
SELECT id AS vec_id, {r6('l1')} AS l1, {r6('sqrt(l2sq)')} AS l2, {r6('l2sq')} AS l2sq, {r6('linf')} AS linf,
       {r6('pow(l3c, 1.0 / 3)')} AS l3, {r6('cs')} AS cosine,
       {r6('acos(least(1.0, greatest(-1.0, cs)))')} AS angle, {r6('sqrt(mh)')} AS mahalanobis FROM e""")
def vector_distances(spark, sf):
    """l1, l2, l2^2, l_inf, l_3, cosine, angle, diagonal Mahalanobis to the label centre."""
    pts = points(spark, sf)
    cids, C = label_centers(pts)
    var = (pts.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.var_pop("v").alias("var"))
           .orderBy("j").collect())
    varv = [r["var"] for r in var]
    cen = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in C]),
                       F.col("label") + 1)
    return pts.select(
        F.col("id").alias("vec_id"),
        _r6(V.l1("x", cen)).alias("l1"), _r6(V.l2("x", cen)).alias("l2"),
        _r6(V.sqdist("x", cen)).alias("l2sq"), _r6(V.linf("x", cen)).alias("linf"),
        _r6(V.lp("x", cen, 3.0)).alias("l3"), _r6(V.cosine("x", cen)).alias("cosine"),
        _r6(V.angle("x", cen)).alias("angle"),
        _r6(V.mahalanobis_diag("x", cen, varv)).alias("mahalanobis"))


# ---------------------------------------------------------------- C3 / C4 / D9
@query("nearest_center", f"WITH {ASSIGN} SELECT id AS vec_id, cid, {r6('d2')} AS d2 FROM asg")
def nearest_center(spark, sf):
    """Nearest label centre of every point (Arrow batch distance block)."""
    pts = points(spark, sf)
    a = K.nearest_center(pts, label_centers(pts))
    return a.select(F.col("id").alias("vec_id"), "cid", _r6(F.col("d2")).alias("d2"))


@query("center_stats_join_back", f"""WITH {ASSIGN},
cs AS (SELECT cid, count(*) AS n_cell, sum(d2) AS sum_d2 FROM asg GROUP BY cid)
SELECT a.id AS vec_id, a.cid, {r6('a.d2')} AS d2, cs.n_cell, {r6('cs.sum_d2')} AS sum_d2
FROM asg a JOIN cs USING (cid)""")
def center_stats_join_back(spark, sf):
    """C4: per-cell count and distance sum attached to each point."""
    pts = points(spark, sf)
    a = K.with_cell_stats(K.nearest_center(pts, label_centers(pts)))
    return a.select(F.col("id").alias("vec_id"), "cid", _r6(F.col("d2")).alias("d2"), "n_cell",
                    _r6(F.col("sum_d2")).alias("sum_d2"))


@query("coreset_stats", f"""WITH {ASSIGN}
SELECT cid, count(*) AS n_cell, {r6('sum(d2)')} AS sum_d2, {r6('(SELECT avg(d2) FROM asg)')} AS c_phi
FROM asg GROUP BY cid""")
def coreset_stats(spark, sf):
    """c_phi (mean min distance), per-cell count and distance sum."""
    pts = points(spark, sf)
    a = K.nearest_center(pts, label_centers(pts)).persist(StorageLevel.MEMORY_AND_DISK)
    cphi = a.agg(F.avg("d2")).first()[0]
    return K.cell_stats(a).select("cid", "n_cell", _r6(F.col("sum_d2")).alias("sum_d2"),
                                  _r6(F.lit(cphi)).alias("c_phi"))


# ---------------------------------------------------------------- D7 / D8
@query("kmeans_update", f"""WITH {ASSIGN},
nw AS (SELECT a.cid, p.j, avg(p.v) AS v FROM asg a JOIN pl p USING (id) GROUP BY a.cid, p.j)
SELECT c.cid, c.j::INTEGER AS j, {r6('coalesce(nw.v, c.v)')} AS v
FROM cen c LEFT JOIN nw ON nw.cid = c.cid AND nw.j = c.j""")
def kmeans_update(spark, sf):
    """One Lloyd update from the label centres (empty cell keeps its centre)."""
    pts = points(spark, sf)
    cen = label_centers(pts)
    new = K.kmeans_update(K.nearest_center(pts, cen), cen)
    return K.centers_long(spark, new).select("cid", "j", _r6(F.col("v")).alias("v"))


@query("kmeans_cost", f"WITH {ASSIGN} SELECT {r6('avg(d2)')} AS cost FROM asg")
def kmeans_cost(spark, sf):
    """Mean over points of the min squared distance to the centres."""
    pts = points(spark, sf)
    c = K.kmeans_cost(pts, label_centers(pts))
    return c.select(_r6(F.col("cost")).alias("cost"))


# ---------------------------------------------------------------- K3 / K2 / K1 / E2 / E3
_ALPHA = 16.0 * (math.log2(10) + 2.0)
PROBS = f"""{ASSIGN},
cs AS (SELECT cid, count(*) AS n_cell, sum(d2) AS sum_d2 FROM asg GROUP BY cid),
g AS (SELECT count(*) AS n, avg(d2) AS cphi FROM asg),
sv AS (SELECT a.id, a.cid, a.d2,
              {_ALPHA!r} * a.d2 / g.cphi + 2 * {_ALPHA!r} * cs.sum_d2 / (cs.n_cell * g.cphi)
              + 4.0 * g.n / cs.n_cell AS s
       FROM asg a JOIN cs USING (cid), g),
prob AS (SELECT id, cid, d2, s / (SELECT sum(s) FROM sv) AS q FROM sv)"""


@query("coreset_probs", f"WITH {PROBS} SELECT id AS vec_id, cid, {r6('q')} AS q FROM prob")
def coreset_probs(spark, sf):
    """K3: sensitivity-based sampling probabilities over the full data."""
    pts = points(spark, sf)
    q = K.coreset_probs(pts, label_centers(pts))
    return q.select(F.col("id").alias("vec_id"), "cid", _r6(F.col("q")).alias("q"))


@query("coreset_sample", f"""WITH {PROBS}, {sample_sql('prob', 'q', NS, SEED, 'coreset')}
SELECT id AS vec_id, {r6('weight')} AS weight FROM smp""")
def coreset_sample(spark, sf):
    """K2: 50-point coreset drawn by the sensitivity probabilities, with weights."""
    pts = points(spark, sf)
    cs = K.coreset(pts, label_centers(pts), NS, SEED)
    return cs.select(F.col("id").alias("vec_id"), _r6(F.col("weight")).alias("weight"))


@query("weighted_sample", f"""WITH pts AS (SELECT vec_id AS id, label FROM embeddings),
{sample_sql('pts', '(label + 1)::DOUBLE', NS, SEED, 'race')}
SELECT id AS vec_id, {r6('p')} AS p, {r6('weight')} AS weight FROM smp""")
def weighted_sample_q(spark, sf):
    """50 rows without replacement, probability proportional to label+1."""
    pts = points(spark, sf)
    s = weighted_sample(pts, (F.col("label") + 1).cast("double"), NS, SEED, "id")
    return s.select(F.col("id").alias("vec_id"), _r6(F.col("p")).alias("p"), _r6(F.col("weight")).alias("weight"))


@query("uniform_sample", f"""WITH pts AS (SELECT vec_id AS id FROM embeddings),
{sample_sql('pts', '1.0', NS, SEED, 'uni')}
SELECT id AS vec_id, {r6('weight')} AS weight FROM smp""")
def uniform_sample_q(spark, sf):
    """50 rows uniformly without replacement."""
    s = uniform_sample(points(spark, sf), NS, SEED, "id")
    return s.select(F.col("id").alias("vec_id"), _r6(F.col("weight")).alias("weight"))


@query("d2_sample", f"""WITH {ASSIGN}, {sample_sql('asg', 'd2', NS, SEED, 'd2')}
SELECT id AS vec_id, {r6('p')} AS p, {r6('weight')} AS weight FROM smp""")
def d2_sample(spark, sf):
    """K1: 50 points drawn proportional to the min squared distance to the centres."""
    pts = points(spark, sf)
    s = K.d2_sample(pts, label_centers(pts), NS, SEED)
    return s.select(F.col("id").alias("vec_id"), _r6(F.col("p")).alias("p"), _r6(F.col("weight")).alias("weight"))


@query("weighted_kmeans_cost", f"""WITH {PROBS}, {sample_sql('prob', 'q', NS, SEED, 'coreset')}
SELECT {r6('sum(weight * d2)')} AS cost FROM smp""")
def weighted_kmeans_cost(spark, sf):
    """Sum of weight * min squared distance over the coreset."""
    pts = points(spark, sf)
    cen = label_centers(pts)
    cs = K.coreset(pts, cen, NS, SEED).select("id", "x", "weight")
    return K.kmeans_cost(cs, cen, weight="weight").select(_r6(F.col("cost")).alias("cost"))


@query("coreset_merge", f"""WITH {PROBS}, {sample_sql('prob', 'q', NS, SEED, 'coreset', 'sa')},
{sample_sql('prob', 'q', NS, SEED + 1, 'coreset', 'sb')}
SELECT id AS vec_id, 0 AS part, {r6('weight')} AS weight FROM sa
UNION ALL SELECT id AS vec_id, 1 AS part, {r6('weight')} AS weight FROM sb""")
def coreset_merge(spark, sf):
    """S3: the union of two coresets (two seeds) is a coreset."""
    pts = points(spark, sf)
    cen = label_centers(pts)
    a = K.coreset(pts, cen, NS, SEED).select("id", F.lit(0).alias("part"), "weight")
    b = K.coreset(pts, cen, NS, SEED + 1).select("id", F.lit(1).alias("part"), "weight")
    u = a.unionByName(b)
    return u.select(F.col("id").alias("vec_id"), "part", _r6(F.col("weight")).alias("weight"))


# ---------------------------------------------------------------- K4 / K5
def _kpp_sql(k: int, seed: int) -> str:
    parts = [PTS]
    parts.append(f"""
k0 AS (SELECT id FROM pts ORDER BY -ln({uniform(f"'{seed}:kpp:0:' || id")}), id LIMIT 1)""")
    prev_md = None
    for r in range(1, k):
        d = f"""
dd{r} AS (SELECT p.id, sum((p.v - c.v) * (p.v - c.v)) AS d FROM pl p
          JOIN pl c ON c.j = p.j AND c.id = (SELECT id FROM k{r - 1}) GROUP BY p.id)"""
        md = (f"md{r} AS (SELECT id, d AS md FROM dd{r})" if prev_md is None else
              f"md{r} AS (SELECT a.id, least(a.md, b.d) AS md FROM {prev_md} a JOIN dd{r} b USING (id))")
        pick = f"""
k{r} AS (SELECT id FROM md{r} WHERE md > 0
         ORDER BY -ln({uniform(f"'{seed}:kpp:{r}:' || id")}) / md, id LIMIT 1)"""
        parts += [d, "\n" + md, pick]
        prev_md = f"md{r}"
    sel = " UNION ALL ".join(f"SELECT {r} AS cid, id AS vec_id FROM k{r}" for r in range(k))
    return "WITH " + ",".join(parts) + "\n" + sel


@query("kmeans_pp", _kpp_sql(3, SEED))
def kmeans_pp(spark, sf):
    """K4: k-means++ seeding (k=3) by md5 exponential races over the full data."""
    c = K.kmeans_pp(points(spark, sf), 3, SEED)
    return c.select("cid", F.col("id").alias("vec_id"))


def _lloyd_sql(rounds: int) -> str:
    parts = [PTS, "\nc0 AS (SELECT cid, j, v FROM cen)"]
    for r in range(1, rounds + 1):
        parts.append(assign_cte(f"a{r}", f"c{r - 1}"))
        parts.append(f"""
n{r} AS (SELECT a.cid, p.j, avg(p.v) AS v FROM a{r} a JOIN pl p USING (id) GROUP BY a.cid, p.j),
c{r} AS (SELECT o.cid, o.j, coalesce(n.v, o.v) AS v FROM c{r - 1} o
         LEFT JOIN n{r} n ON n.cid = o.cid AND n.j = o.j)""")
    return ("WITH " + ",".join(parts) +
            f"\nSELECT cid, j::INTEGER AS j, {r6('v')} AS v FROM c{rounds}")


@query("kmeans_lloyd", _lloyd_sql(3))
def kmeans_lloyd(spark, sf):
    """K5: three Lloyd rounds from the label centres (distributed assign + mean)."""
    pts = points(spark, sf)
    (cids, C), _ = K.kmeans_lloyd(pts, label_centers(pts), max_iter=3, tol=0.0)
    return K.centers_long(spark, (cids, C)).select("cid", "j", _r6(F.col("v")).alias("v"))


# ---------------------------------------------------------------- R-checked jobs
@query("coreset_kmeans")
def coreset_kmeans(spark, sf):
    """K6: coreset over the full data, k-means++ and weighted Lloyd on it, Lloyd on all points."""
    pts = points(spark, sf)
    (cids, C), rounds = K.coreset_kmeans(pts.select("id", "x"), 10, 40, 200, SEED)
    cost = K.kmeans_cost(pts, (cids, C)).first()["cost"]
    return K.centers_long(spark, (cids, C)).withColumn("cost", F.lit(cost)).withColumn("rounds", F.lit(rounds))


@query("kmeans_baseline")
def kmeans_baseline(spark, sf):
    """K7: library k-means (Spark ML, k-means||) fit on train rows, cost on held-out rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    pts = points(spark, sf).withColumn("features", array_to_vector("x"))
    from tessera.functions.hashing import uniform
    test = uniform(SEED, "split", F.col("id")) < 0.2  # same held-out rule as the linear queries
    model = KMeans(k=10, seed=SEED, maxIter=20).fit(pts.where(~test))
    C = model.clusterCenters()
    import numpy as np
    cen = (np.arange(len(C), dtype=np.int32), np.array(C))
    a = K.nearest_center(pts.where(test), cen)
    return a.groupBy("cid").agg(F.count(F.lit(1)).alias("n"), _r6(F.avg("d2")).alias("mean_d2"))


@query("kmeans_parallel")
def kmeans_parallel(spark, sf):
    """K4 for large k: 20 centres by oversampling rounds, with the mean cost they leave."""
    pts = points(spark, sf).select("id", "x")
    c = K.kmeans_parallel(pts, 20, SEED)
    cost = K.kmeans_cost(pts, K.drawn_centers(c.select("id", "x"))).first()["cost"]
    return c.select("cid", F.col("id").alias("vec_id"), F.lit(cost).alias("cost"))


@query("coreset_quality", f"""WITH {PROBS}, {sample_sql('prob', 'q', 200, SEED, 'coreset')},
f AS (SELECT sum(d2) AS full_cost FROM asg), c AS (SELECT sum(weight * d2) AS core FROM smp)
SELECT {r6('full_cost')} AS full_cost, {r6('core')} AS coreset_cost, {r6('core / full_cost')} AS ratio FROM f, c""")
def coreset_quality(spark, sf):
    """Coreset cost / full cost for the label centres (the (k, eps) test)."""
    pts = points(spark, sf)
    cen = label_centers(pts)
    full = K.kmeans_cost(pts, cen, mean=False)
    core = K.kmeans_cost(K.coreset(pts, cen, 200, SEED).select("id", "x", "weight"), cen, weight="weight")
    both = full.select(F.col("cost").alias("f"), F.lit(None).cast("double").alias("c")).unionByName(
        core.select(F.lit(None).cast("double").alias("f"), F.col("cost").alias("c"))).agg(F.max("f").alias("f"), F.max("c").alias("c"))
    return both.select(_r6(F.col("f")).alias("full_cost"), _r6(F.col("c")).alias("coreset_cost"), _r6(F.col("c") / F.col("f")).alias("ratio"))


_COMPRESS_SQL = f"""{PROBS}, {sample_sql('prob', 'q', 200, SEED, 'coreset', 'c1')},
ws AS (SELECT id, cid, d2, weight AS w0 FROM c1),
wcs AS (SELECT cid, sum(w0) AS n_cell, sum(w0 * d2) AS sum_d2 FROM ws GROUP BY cid),
wg AS (SELECT sum(w0) AS n, sum(w0 * d2) / sum(w0) AS cphi FROM ws),
wsv AS (SELECT ws.id, ws.w0, ws.w0 * ({_ALPHA!r} * ws.d2 / wg.cphi + 2 * {_ALPHA!r} * wcs.sum_d2 / (wcs.n_cell * wg.cphi)
               + 4.0 * wg.n / wcs.n_cell) AS s FROM ws JOIN wcs USING (cid), wg),
wprob AS (SELECT id, w0, s / (SELECT sum(s) FROM wsv) AS q FROM wsv)"""


@query("coreset_compress", f"""WITH {_COMPRESS_SQL}, {sample_sql('wprob', 'q', NS, SEED + 3, 'coreset')}
SELECT id AS vec_id, {r6('w0 * weight')} AS weight FROM smp""")
def coreset_compress(spark, sf):
    """50 points of a weighted 200-point coreset, drawn by the weighted sensitivities."""
    pts = points(spark, sf)
    cen = label_centers(pts)
    cs = K.coreset(pts, cen, 200, SEED).select("id", "x", "weight")
    return K.coreset_compress(cs, cen, NS, SEED + 3).select(F.col("id").alias("vec_id"), _r6(F.col("weight")).alias("weight"))


@query("halving_coreset")
def halving_coreset(spark, sf):
    """K9: a halving coreset: union of draws, their cells, weighted draws from all points."""
    pts = points(spark, sf).select("id", "x")
    c = K.halving_coreset(pts, k=2, eps=0.9, seed=SEED, n_draw=300)
    return c.select(F.col("id").alias("vec_id"), "b", "cid", _r6(F.col("d2")).alias("d2"), _r6(F.col("q")).alias("q"), "times", _r6(F.col("weight")).alias("weight"))


# ---------------------------------------------------------------- G4 with a full matrix
#: G = the upper triangle with 0.5^(j - i): ||G w||^2 = sum_i (sum_{j >= i} 0.5^(j - i) w_j)^2
@query("mahalanobis_full", f"""WITH {PTS},
w AS (SELECT p.id, p.j, p.v - c.v AS v FROM pl p JOIN cen c ON c.cid = p.label AND c.j = p.j),
g AS (SELECT a.id, a.j, sum(pow(0.5, b.j - a.j) * b.v) AS v FROM w a JOIN w b ON a.id = b.id AND b.j >= a.j GROUP BY a.id, a.j),
m AS (SELECT id, sqrt(sum(v * v)) AS norm FROM g GROUP BY id),
xy AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
s AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy FROM xy)
SELECT m.id AS vec_id, {r6('norm')} AS norm,
       {r6('sqrt((yy * (x - mx) * (x - mx) - 2 * s.xy * (x - mx) * (y - my) + xx * (y - my) * (y - my)) / (xx * yy - s.xy * s.xy))')} AS whitened
FROM m JOIN xy USING (id), s""")
def mahalanobis_full(spark, sf):
    """||G (x - label centre)|| for a full matrix G, and the distance from the mean of the
    first two coordinates under their covariance (whitening by its Cholesky factor)."""
    pts = points(spark, sf)
    cids, C = label_centers(pts)
    d = C.shape[1]
    G = np.triu(0.5 ** np.clip(np.arange(d)[None, :] - np.arange(d)[:, None], 0, None))
    two = pts.select("id", "label", "x", F.slice("x", 1, 2).alias("xy"))
    mean, W = whitening(two, "xy")
    own = mahalanobis(two, G, "x", dict(zip(cids.tolist(), C)), "label", out="norm")
    return mahalanobis(own, W, "xy", mean, out="whitened").select(F.col("id").alias("vec_id"), _r6(F.col("norm")).alias("norm"), _r6(F.col("whitened")).alias("whitened"))
