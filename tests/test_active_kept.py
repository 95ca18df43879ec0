"""A round leaves its labelled rows in few partitions with a short plan, so later rounds recompute nothing."""

import numpy as np
from pyspark import StorageLevel

from tessera.operators import active as A
from tessera.operators import linear as L


def test_training_keeps_the_callers_rows(spark):
    rows = [(i, 1.0 if i % 2 else -1.0, [1.0, float(i % 7), float(i % 2)]) for i in range(300)]
    d = spark.createDataFrame(rows, "id bigint, y double, x array<double>").repartition(40)
    labels = d.select("id", "y").repartition(40)
    index = A.HyperplaneIndex(d.select("id", "x"), 3, 4, 1)
    lab = A.together(d.where("id < 20"), 20).cache()
    w = L.pegasos(lab, 0.01, 2)
    assert lab.select("id", "y", "x").storageLevel != StorageLevel.NONE
    for r in range(2):
        lab, w, c = A.active_round(index, lab, labels, w, 10, 0.01, 2, 1, r, explore=0.2)
        assert c["labeled"] == 20 + 10 * (r + 1)
        assert len(lab._jdf.queryExecution().logical().toString().splitlines()) == 1
    assert lab.rdd.getNumPartitions() <= 3
    assert np.isfinite(w).all()
    free = d.where("id < 50").select("id", "y", "x")
    L.pegasos(free, 0.01, 1)
    assert free.storageLevel == StorageLevel.NONE             # what training persisted itself is released
