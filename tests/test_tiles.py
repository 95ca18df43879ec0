"""Rows of a crowded ring are not sent once for each of many small tiles."""

import numpy as np

from tessera.operators import metric_join as M
from tests.test_metric_join import cloud


def test_a_crowded_ring_sends_its_rows_once(spark):
    x = np.random.default_rng(2).normal(size=(6000, 4)) * 0.01
    df = cloud(spark, x)
    P = M.choose_pivots(df, 1, 3)
    placed = M._placed(df, P, M._radii(df, P), 1.0)
    assert M._tiled(placed).count() <= placed.count()        # three tiles and twice the rows and more before


def test_guests_and_visitors_in_tiles(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(300, 3))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    x[7] = np.nan                                            # near nothing, and hides nobody
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(d <= 0.7, 1))) if 7 not in (i, j)}
    for tile in (M.TILE, 25):
        monkeypatch.setattr(M, "TILE", tile)
        monkeypatch.setattr(M, "STRIP", 7)
        got = [(r.id_a, r.id_b) for r in M.distance_join(cloud(spark, x), 0.7, 6, 3).collect()]
        assert len(got) == len(set(got)) and set(got) == want
