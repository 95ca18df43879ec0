import math

from pyspark.sql import functions as F

from tessera.operators import cluster as K
from tessera.operators import linear as L
from tessera.operators.sampling import uniform_sample
from tessera.plans import q_cluster as QC
from tessera.plans import q_linear as QL
from tests.conftest import SF0001, SF001


def test_margin_selection_looks_at_all_rows_inside_the_margin(spark):
    d = QL.labeled(spark, SF0001)
    w = L.pegasos(uniform_sample(d.where(~F.col("test")), 30, QL.SEED, "id").select("id", "y", "x"), QL.LAM, 5)
    inside = {r.id for r in L.svm_score(d.where("test"), w).where("abs(score) < 1").collect()}
    got = [r.id for r in QL.margin_selection(spark, SF0001).collect()]
    assert len(inside) > 10 and sorted(got) == sorted(inside)


def test_halving_coreset_draws_what_the_operator_asks_for(spark):
    """The query's draws have the operator's own size, 10 d k log(1/eps) points, and several are made."""
    m = math.ceil(10 * 64 * 2 * math.log(1 / 0.9))
    pts = QC.points(spark, SF001).select("id", "x")
    sizes = {r.b: r["count"] for r in K.halving_draws(pts, m, QC.SEED).groupBy("b").count().collect()}
    n, want, b = pts.count(), {}, 0
    while n > m:
        want[b], n, b = m, n - n // 2, b + 1
    want[b] = n
    assert sizes == want and len(want) >= 3
    rows = QC.halving_coreset(spark, SF001).collect()
    assert {r.b for r in rows} == set(want) and 200 < sum(r.times for r in rows) < 400
