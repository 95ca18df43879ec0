"""Greedy selection queries: document shingle cover and facility location."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import lsh
from tessera.operators import select as X
from tessera.plans.q_cluster import PTS, label_centers, points
from tessera.plans.registry import query, table
from tessera.plans.sqlparts import r6, shingles_cte

K = 3


def _elements(spark, sf):
    s = lsh.shingle(table(spark, sf, "documents"))
    return s.select(F.col("doc_id").alias("set_id"), F.explode("shingles").alias("elem"))


def _cover_sql(k: int) -> str:
    parts = [shingles_cte(), "\nel AS (SELECT DISTINCT doc_id, unnest(s) AS e FROM sh)"]
    for r in range(1, k + 1):
        where = "" if r == 1 else f"WHERE e NOT IN (SELECT e FROM cov{r - 1})"
        parts.append(f"""
g{r} AS (SELECT doc_id, count(*) AS gain FROM el {where} GROUP BY doc_id ORDER BY gain DESC, doc_id LIMIT 1)""")
        prev = "" if r == 1 else f"SELECT e FROM cov{r - 1} UNION "
        parts.append(f"""
cov{r} AS ({prev}SELECT e FROM el WHERE doc_id = (SELECT doc_id FROM g{r}))""")
    sel = " UNION ALL ".join(f"SELECT {r} AS round, doc_id AS set_id, gain FROM g{r}" for r in range(1, k + 1))
    return "WITH " + ",".join(parts) + "\n" + sel


@query("greedy_cover", _cover_sql(K))
def greedy_cover(spark, sf):
    """3 documents covering the most distinct shingles (greedy, anti-join residual)."""
    return X.greedy_cover(_elements(spark, sf), K)


@query("lazy_greedy_cover", _cover_sql(K))
def lazy_greedy_cover(spark, sf):
    """Lazy greedy with stale upper bounds; same picks as X1."""
    return X.lazy_greedy_cover(_elements(spark, sf), K)


def _fl_sql(k: int) -> str:
    parts = [PTS, """
m AS (SELECT p.id, c.cid, 1.0 + sum(p.v * c.v) AS m FROM pl p JOIN cen c ON c.j = p.j GROUP BY p.id, c.cid),
c0 AS (SELECT DISTINCT id, 0.0 AS cur FROM pl)"""]
    for r in range(1, k + 1):
        excl = " AND ".join(f"m.cid <> (SELECT cid FROM w{q})" for q in range(1, r)) or "TRUE"
        parts.append(f"""
w{r} AS (SELECT m.cid, sum(greatest(0.0, m.m - c.cur)) AS gain FROM m JOIN c{r - 1} c USING (id)
         WHERE {excl} GROUP BY m.cid ORDER BY gain DESC, m.cid LIMIT 1),
c{r} AS (SELECT c.id, greatest(c.cur, m.m) AS cur FROM c{r - 1} c JOIN m ON m.id = c.id
         AND m.cid = (SELECT cid FROM w{r}))""")
    sel = " UNION ALL ".join(f"SELECT {r} AS round, cid::BIGINT AS facility, {r6('gain')} AS gain FROM w{r}"
                             for r in range(1, k + 1))
    return "WITH " + ",".join(parts) + "\n" + sel


@query("facility_location", _fl_sql(K))
def facility_location(spark, sf):
    """3 facilities among the label centres maximising sum_i max_j (1 + x_i . f_j)."""
    pts = points(spark, sf)
    cids, C = label_centers(pts)
    r = X.facility_location(pts.select("id", "x"), C, [int(c) for c in cids], K)
    return r.select("round", "facility", (F.round("gain", 6) + F.lit(0.0)).alias("gain"))
