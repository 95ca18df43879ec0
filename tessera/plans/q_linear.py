"""Linear-classification queries over ``embeddings``.

Labelled vectors: y = +1 if label < 5 else -1, x = the 64-d embedding; a row
is held out for testing when md5-uniform(7:split:id) < 0.2.  The fixed
model used by the exact checks is the mean of y * f(x) over training rows
(a centroid classifier), computed from the data by both engines.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.features import poly2, rff
from tessera.functions.hashing import gaussian_matrix, uniform, uniform_vector
from tessera.operators import linear as L
from tessera.operators.sampling import batch_assign, shuffle_order
from tessera.plans.registry import query, table
from tessera.session import cut_lineage
from tessera.plans.sqlparts import gaussian as sql_gaussian
from tessera.plans.sqlparts import r6
from tessera.plans.sqlparts import uniform as sql_uniform
from tessera.sources.lines import labeled_lines, parse_labeled_lines

SEED = 7
LAM = 0.1


def _r6(c):
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def labeled(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.when(F.col("label") < 5, 1.0).otherwise(-1.0).alias("y"),
                    F.col("embedding").cast("array<double>").alias("x"), "label",
                    (uniform(SEED, "split", F.col("vec_id")) < 0.2).alias("test"))


def centroid_model(train, features):
    s, n = L.vector_sum(train, features, coef="y")
    return s / max(n, 1)


LAB = f"""
lab AS (SELECT vec_id AS id, CASE WHEN label < 5 THEN 1.0 ELSE -1.0 END AS y, label,
               embedding::DOUBLE[] AS x, {sql_uniform(f"'{SEED}:split:' || vec_id")} < 0.2 AS test
        FROM embeddings),
ll AS (SELECT id, y, label, test, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM lab),
dim AS (SELECT max(i) + 1 AS d FROM ll),
ntr AS (SELECT count(*) AS n FROM lab WHERE NOT test)"""

P2 = LAB + """,
p2 AS (SELECT a.id, a.y, a.test, a.i * (SELECT d FROM dim) + b.i AS j,
              a.v * b.v * CASE WHEN a.i = b.i THEN 1.0 ELSE sqrt(2.0) END AS v
       FROM ll a JOIN ll b ON a.id = b.id),
w2 AS (SELECT j, sum(y * v) / (SELECT n FROM ntr) AS w FROM p2 WHERE NOT test GROUP BY j),
sc AS (SELECT p2.id, any_value(p2.y) AS y, any_value(p2.test) AS test, sum(p2.v * w2.w) AS score
       FROM p2 JOIN w2 USING (j) GROUP BY p2.id)"""

RAW = LAB + """,
w1 AS (SELECT i AS j, sum(y * v) / (SELECT n FROM ntr) AS w FROM ll WHERE NOT test GROUP BY i),
sc1 AS (SELECT ll.id, any_value(ll.y) AS y, any_value(ll.test) AS test, sum(ll.v * w1.w) AS score
        FROM ll JOIN w1 ON w1.j = ll.i GROUP BY ll.id)"""


def _scored_poly2(spark, sf):
    d = labeled(spark, sf)
    w = centroid_model(d.where(~F.col("test")), "poly2")
    return L.svm_score(d, w, "poly2"), w


# ---------------------------------------------------------------- B5 / H4
@query("poly2_features", f"""WITH {P2}
SELECT id, count(*)::INTEGER AS width, {r6('sum(v)')} AS sum_v, {r6('sum(v * v)')} AS sumsq_v FROM p2 GROUP BY id""")
def poly2_features(spark, sf):
    """Degree-2 feature map (d^2 = 4096 wide, sqrt2 in both triangles)."""
    d = labeled(spark, sf)
    f = d.select("id", poly2("x").alias("f"))
    return f.select("id", F.size("f").alias("width"),
                    _r6(F.aggregate("f", F.lit(0.0), lambda a, v: a + v)).alias("sum_v"),
                    _r6(F.aggregate("f", F.lit(0.0), lambda a, v: a + v * v)).alias("sumsq_v"))


# ---------------------------------------------------------------- F1 / B2 / D6 / D14 / E6
@query("svm_score", f"WITH {P2} SELECT id, {r6('score')} AS score FROM sc")
def svm_score(spark, sf):
    """<w, poly2(x)> for every row, evaluated as x^T M x in Arrow batches."""
    s, _ = _scored_poly2(spark, sf)
    return s.select("id", _r6(F.col("score")).alias("score"))


@query("margin_violators", f"WITH {P2} SELECT id, {r6('y * score * 100')} AS margin FROM sc WHERE y * score * 100 < 1")
def margin_violators(spark, sf):
    """B2: rows with y * <100 w, f(x)> < 1 (strict)."""
    d = labeled(spark, sf)
    w = 100 * centroid_model(d.where(~F.col("test")), "poly2")
    v = L.margin_violators(L.svm_score(d, w, "poly2"))
    return v.select("id", _r6(F.col("y") * F.col("score")).alias("margin"))


@query("svm_accuracy", f"""WITH {P2}
SELECT {r6('avg(CASE WHEN y * score > 0 THEN 1.0 ELSE 0.0 END)')} AS accuracy, count(*) AS n FROM sc WHERE test""")
def svm_accuracy(spark, sf):
    """Accuracy on the held-out rows (zero score counts as wrong)."""
    s, _ = _scored_poly2(spark, sf)
    a = L.svm_accuracy(s.where("test"))
    return a.select(_r6(F.col("accuracy")).alias("accuracy"), "n")


@query("svm_objective", f"""WITH {P2}
SELECT {r6(f'0.5 * {LAM} * (SELECT sum(w * w) FROM w2) + avg(greatest(0.0, 1 - y * score))')} AS objective,
       {r6('avg(greatest(0.0, 1 - y * score))')} AS mean_hinge FROM sc WHERE NOT test""")
def svm_objective(spark, sf):
    """lambda/2 ||w||^2 + mean hinge over the training rows."""
    s, w = _scored_poly2(spark, sf)
    o = L.svm_objective(s.where(~F.col("test")), w, LAM)
    return o.select(_r6(F.col("objective")).alias("objective"), _r6(F.col("mean_hinge")).alias("mean_hinge"))


@query("uncertainty_topm", f"""WITH {P2}
SELECT id, {r6('score')} AS score FROM sc WHERE test ORDER BY abs(score), id LIMIT 20""")
def uncertainty_topm(spark, sf):
    """The 20 held-out rows closest to the decision boundary."""
    s, _ = _scored_poly2(spark, sf)
    return L.uncertainty_topm(s.where("test"), 20).select("id", _r6(F.col("score")).alias("score"))


# ---------------------------------------------------------------- D15
@query("multiclass_hinge", f"""WITH {LAB},
W AS (SELECT label AS c, i, avg(v) AS w FROM ll GROUP BY label, i),
s AS (SELECT ll.id, W.c, any_value(ll.label) AS label, sum(ll.v * W.w) AS s
      FROM ll JOIN W ON W.i = ll.i GROUP BY ll.id, W.c),
sy AS (SELECT id, s AS sy FROM s WHERE c = label)
SELECT s.id, {r6('max(greatest(0.0, 1.0 - sy.sy + s.s))')} AS loss
FROM s JOIN sy USING (id) WHERE s.c <> s.label GROUP BY s.id""")
def multiclass_hinge(spark, sf):
    """Multiclass hinge with W = per-label mean vectors."""
    from tessera.plans.q_cluster import label_centers, points
    pts = points(spark, sf)
    _, W = label_centers(pts)
    r = L.multiclass_hinge(pts, W)
    return r.select("id", _r6(F.col("loss")).alias("loss"))


# ---------------------------------------------------------------- D5 / E5 / E4
@query("weight_average", f"""WITH {LAB},
bw AS (SELECT id // 100 AS batch, i AS j, avg(y * v) AS w FROM ll GROUP BY id // 100, i)
SELECT j::INTEGER AS j, {r6('avg(w)')} AS w FROM bw GROUP BY j""")
def weight_average(spark, sf):
    """Per-batch models (batch = id div 100, model = mean y x) averaged element-wise."""
    d = batch_assign(labeled(spark, sf), 100)
    per = d.select("batch", F.posexplode("x").alias("j", "v"), "y").groupBy("batch", "j").agg(
        F.avg(F.col("y") * F.col("v")).alias("w"))
    return L.weight_average(per).select(F.col("j").cast("int"), _r6(F.col("w")).alias("w"))


@query("shuffle_rows", f"""SELECT vec_id AS id, vec_id // 100 AS batch,
row_number() OVER (PARTITION BY vec_id // 100 ORDER BY md5('{SEED}:' || vec_id), vec_id) AS pos FROM embeddings""")
def shuffle_rows(spark, sf):
    """E5 + E4: fixed-size batches by id and a seeded permutation inside each."""
    d = batch_assign(labeled(spark, sf).select("id"), 100)
    return shuffle_order(d, SEED).select("id", "batch", "pos")


# ---------------------------------------------------------------- E8
@query("l1_projection", f"""WITH {RAW},
a AS (SELECT j, w, abs(w) AS u FROM w1),
r AS (SELECT j, w, u, row_number() OVER (ORDER BY u DESC, j) AS rk,
             sum(u) OVER (ORDER BY u DESC, j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM a),
best AS (SELECT rk, cs FROM r WHERE u - (cs - 0.5) / rk > 0 ORDER BY rk DESC LIMIT 1),
th AS (SELECT CASE WHEN (SELECT sum(u) FROM a) <= 0.5 THEN 0.0 ELSE (cs - 0.5) / rk END AS theta FROM best)
SELECT j::INTEGER AS j, {r6('sign(w) * greatest(abs(w) - (SELECT theta FROM th), 0.0)')} AS w FROM a""")
def l1_projection(spark, sf):
    """The raw centroid model projected onto the L1 ball of radius 0.5."""
    d = labeled(spark, sf)
    w = centroid_model(d.where(~F.col("test")), "raw")
    m = L.l1_projection(L.model_table(spark, w), 0.5)
    return m.select(F.col("j").cast("int"), _r6(F.col("w")).alias("w"))


# ---------------------------------------------------------------- F5
def _pegasos_sql(steps: int, lam: float) -> str:
    parts = [LAB, "\nq0 AS (SELECT DISTINCT i AS j, 0.0 AS w FROM ll)"]
    for t in range(1, steps + 1):
        eta = 1.0 / (lam * t)
        parts.append(f"""
s{t} AS (SELECT ll.id, any_value(ll.y) AS y, sum(ll.v * q.w) AS score
         FROM ll JOIN q{t - 1} q ON q.j = ll.i WHERE NOT ll.test GROUP BY ll.id),
g{t} AS (SELECT ll.i AS j, sum(ll.y * ll.v) AS g FROM ll JOIN s{t} USING (id)
         WHERE s{t}.y * s{t}.score < 1 GROUP BY ll.i),
u{t} AS (SELECT q.j, {1 - eta * lam!r} * q.w + {eta!r} / (SELECT n FROM ntr) * coalesce(g.g, 0.0) AS w
         FROM q{t - 1} q LEFT JOIN g{t} g USING (j)),
q{t} AS (SELECT j, w * CASE WHEN (SELECT sqrt(sum(w * w)) FROM u{t}) > 0
                       THEN least(1.0, {1 / math.sqrt(lam)!r} / (SELECT sqrt(sum(w * w)) FROM u{t})) ELSE 1.0 END AS w
         FROM u{t})""")
    return "WITH " + ",".join(parts) + f"\nSELECT j::INTEGER AS j, {r6('w')} AS w FROM q{steps}"


@query("pegasos", _pegasos_sql(2, LAM))
def pegasos_q(spark, sf):
    """two full-batch Pegasos steps (lambda = 0.1) on the training rows."""
    d = labeled(spark, sf)
    w = L.pegasos(d.where(~F.col("test")), LAM, 2)
    return L.model_table(spark, w).select(F.col("j").cast("int"), _r6(F.col("w")).alias("w"))


# ---------------------------------------------------------------- G7 / G8
@query("rbf_kernel_scores", f"""WITH {LAB},
cen AS (SELECT label AS c, i, avg(v) AS v FROM ll GROUP BY label, i),
d2 AS (SELECT ll.id, cen.c, sum((ll.v - cen.v) * (ll.v - cen.v)) AS d2 FROM ll JOIN cen ON cen.i = ll.i
       GROUP BY ll.id, cen.c)
SELECT id, {r6('sum(CASE WHEN c < 5 THEN 1.0 ELSE -1.0 END * exp(-1.0 * d2))')} AS kscore FROM d2 GROUP BY id""")
def rbf_kernel_scores(spark, sf):
    """RBF kernel scores against the 10 label centres (alpha = 1, y_c = +-1, gamma = 1)."""
    from tessera.plans.q_cluster import label_centers, points
    pts = points(spark, sf)
    cids, C = label_centers(pts)
    coef = np.where(cids < 5, 1.0, -1.0)
    r = L.rbf_kernel_scores(pts, C, coef, 1.0)
    return r.select("id", _r6(F.col("kscore")).alias("kscore"))


RFF_M = 16


@query("rff_features", f"""WITH {LAB},
W AS (SELECT f, i, {sql_gaussian(f"'{SEED}:rff:' || f || ':' || i")} AS w
      FROM range({RFF_M}) a(f), range(64) b(i)),
bb AS (SELECT f, 2 * pi() * {sql_uniform(f"'{SEED}:rffb:' || f")} AS b FROM range({RFF_M}) a(f)),
z AS (SELECT ll.id, W.f, sqrt(2.0 / {RFF_M}) * cos(sum(ll.v * W.w) + any_value(bb.b)) AS z
      FROM ll JOIN W ON W.i = ll.i JOIN bb ON bb.f = W.f GROUP BY ll.id, W.f)
SELECT id, {r6('sum(z)')} AS rff_sum, {r6('sum(z * z)')} AS rff_sumsq FROM z GROUP BY id""")
def rff_features(spark, sf):
    """16 random Fourier features (md5 Box-Muller W, uniform phase)."""
    d = labeled(spark, sf)
    W = gaussian_matrix(RFF_M, 64, SEED, "rff")
    b = 2 * math.pi * uniform_vector(RFF_M, SEED, "rffb")
    z = d.select("id", rff("x", W, b).alias("z"))
    return z.select("id", _r6(F.aggregate("z", F.lit(0.0), lambda a, v: a + v)).alias("rff_sum"),
                    _r6(F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v)).alias("rff_sumsq"))


# ---------------------------------------------------------------- A4
@query("parse_labeled_lines", f"""WITH {LAB}
SELECT id, y, len(x)::INTEGER AS n, {r6('list_sum(x)')} AS sum_x FROM lab""")
def parse_labeled_lines_q(spark, sf):
    """A4: 'y f1 ... fd' lines (written from embeddings) parsed back."""
    lines = labeled_lines(labeled(spark, sf))
    p = parse_labeled_lines(lines, id_col="id")
    return p.select("id", "y", F.size("x").alias("n"),
                    _r6(F.aggregate("x", F.lit(0.0), lambda a, v: a + v)).alias("sum_x"))


# ---------------------------------------------------------------- R-checked training jobs
def _train_eval(spark, sf, method, features="poly2", batch=100, lam=1.0):
    d = labeled(spark, sf)
    model = L.parallel_svm(d.where(~F.col("test")), batch, SEED, features, method, lam=lam)
    D = 64 * 64 if features == "poly2" else 64
    w = L.model_vector(model, D)
    acc = L.svm_accuracy(L.svm_score(d.where("test"), w, features))
    return acc.select(F.lit(method).alias("method"), _r6(F.col("accuracy")).alias("accuracy"), "n")


@query("parallel_svm_adam")
def parallel_svm_adam(spark, sf):
    """per-batch Adam SVM on poly2 features, averaged; held-out accuracy."""
    return _train_eval(spark, sf, "adam")


@query("parallel_svm_sgd")
def parallel_svm_sgd(spark, sf):
    """per-batch projected SGD (radius 1/lambda), averaged; held-out accuracy."""
    return _train_eval(spark, sf, "sgd", lam=0.5)


@query("psgd")
def psgd(spark, sf):
    """split the training rows into groups of about 500, train each (projected SGD), average."""
    d = labeled(spark, sf)
    model = L.parallel_svm(d.where(~F.col("test")), 500, SEED, "raw", "sgd", lam=0.5)
    w = L.model_vector(model, 64)
    acc = L.svm_accuracy(L.svm_score(d.where("test"), w))
    return acc.select(F.lit("psgd").alias("method"), _r6(F.col("accuracy")).alias("accuracy"), "n")


@query("svm_train_eval")
def svm_train_eval(spark, sf):
    """Adam-trained model scored on held-out rows (raw features)."""
    return _train_eval(spark, sf, "adam", features="raw")


@query("l1_svm")
def l1_svm(spark, sf):
    """Pegasos with projection onto an L1 ball (sparse weights)."""
    d = labeled(spark, sf)
    w = L.pegasos(d.where(~F.col("test")), LAM, 10, batch_size=100, seed=SEED, projection="l1", l1_radius=2.0)
    acc = L.svm_accuracy(L.svm_score(d.where("test"), w)).first()
    return L.model_table(spark, w).withColumn("accuracy", F.lit(acc["accuracy"])) \
        .withColumn("nonzero", F.lit(int((w != 0).sum())))


@query("active_learning_round")
def active_learning_round(spark, sf):
    """F8: start from 20 labelled rows, add the 20 most uncertain per round (3 rounds)."""
    from tessera.operators.sampling import uniform_sample
    d = labeled(spark, sf)
    pool = d.where(~F.col("test")).select("id", "x")
    oracle = d.select("id", "y")
    lab = uniform_sample(d.where(~F.col("test")), 20, SEED, "id").select("id", "y", "x")
    w = L.pegasos(lab, LAM, 5)
    hist = []
    for r in range(3):
        lab, w = L.active_learning_round(pool, lab, oracle, w, 20, LAM, 5)
        acc = L.svm_accuracy(L.svm_score(d.where("test"), w)).first()["accuracy"]
        hist.append((r, lab.count(), float(acc)))
    return spark.createDataFrame(hist, "round int, n_labeled bigint, accuracy double")


def text_vectors(docs):
    """``id, x``: eight shares and logarithms that describe a text (null texts are left out)."""
    n = F.greatest(F.length("text"), F.lit(1)).cast("double")
    count = lambda p: F.length(F.regexp_replace("text", p, "")) / n
    words = F.size(F.split(F.trim("text"), r"\s+")).cast("double")
    x = F.array(F.lit(1.0), F.log1p(n) / 10, count(r"[^A-Za-z]"), count(r"[^0-9]"), count(r"[^A-Z]"), count(r"[^.!?,;:]"),
                count(r"[\p{L}\p{N}\s.!?,;:]") * 5, n / words / 20)
    return docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), x.alias("x"))


@query("active_learning_labels")
def active_learning_labels(spark, sf):
    """F8: quality of documents learned from the labels table in rounds, with a hyperplane
    index, exploration and a subsample; accuracy on held-out labelled documents."""
    from tessera.functions.hashing import uniform
    from tessera.operators import active as A
    vec = text_vectors(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, 1.0).otherwise(-1.0).alias("y"))
    held = uniform(SEED, "split", F.col("id")) < 0.2
    test = vec.join(labels, "id").where(held).cache()
    index = A.HyperplaneIndex(vec.join(labels.select("id").distinct(), "id", "left_semi").where(~held), 8, 8, SEED)
    from tessera.operators.sampling import uniform_sample
    lab = uniform_sample(index.rows.select("id", "x"), 20, SEED, "id").select("id", "x").join(labels, "id").select("id", "y", "x")
    lab = cut_lineage(A.together(lab, 20))
    w, hist = L.pegasos(lab, LAM, 20), []
    for r in range(3):
        lab, w, c = A.active_round(index, lab, labels, w, 20, LAM, 20, SEED, r, prefilter=True, explore=0.2, subsample=0.8)
        acc = L.svm_accuracy(L.svm_score(test, w)).first()["accuracy"]
        hist.append((r, c["candidates"], c["asked"], c["labeled"], float(acc) if acc is not None else None))
    return spark.createDataFrame(hist, "round int, candidates bigint, asked bigint, labeled bigint, accuracy double")


@query("margin_selection_ratio")
def margin_selection_ratio(spark, sf):
    """ratio-margin choice among all held-out rows inside the current margin."""
    from tessera.operators.sampling import uniform_sample
    d = labeled(spark, sf)
    lab = uniform_sample(d.where(~F.col("test")), 30, SEED, "id").select("id", "y", "x")
    cand = L.svm_score(d.where("test"), L.pegasos(lab, LAM, 5)).where(F.abs("score") < 1)
    return L.margin_selection(cand, lab, LAM, 5, rule="ratio").select("id", _r6(F.col("score")).alias("score"))


@query("margin_selection")
def margin_selection(spark, sf):
    """max-min margin choice among all held-out rows inside the current margin."""
    from tessera.operators.sampling import uniform_sample
    d = labeled(spark, sf)
    lab = uniform_sample(d.where(~F.col("test")), 30, SEED, "id").select("id", "y", "x")
    w = L.pegasos(lab, LAM, 5)
    cand = L.svm_score(d.where("test"), w).where(F.abs("score") < 1)
    return L.margin_selection(cand, lab, LAM, 5).select("id", _r6(F.col("score")).alias("score"))
