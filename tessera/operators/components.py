"""Connected components of an edge table by contraction.

Every round each node that has a smaller neighbour hooks to its smallest one,
the hooking forest is compressed by pointer doubling until every pointer names
a root, and the edges are rewritten between roots.  The survivors of a round
are pairwise non-adjacent, so the edge table shrinks quickly; the loop ends
only when no edge is left (there is no round limit).  The smallest id of a
component is never hooked, so the final label is the smallest id.

Only one row count per step reaches the driver.  State is cut with reliable
checkpoints, so a lost executor costs one step.  Popular roots are ordinary
join keys that AQE may split; the aggregates combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _compress(par: DataFrame) -> DataFrame:
    """``node, p`` -> the same nodes with ``p`` the root of their tree."""
    while True:
        up = par.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        nxt = cut_lineage(par.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p"),
                                                           F.col("pp").isNotNull().alias("moved")))
        if nxt.where("moved").limit(1).count() == 0:
            return par
        par = nxt.select("node", "p")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an undirected edge table.

    ``component`` is the smallest id reachable.  Self loops and null ends are
    ignored; a node that only occurs in a self loop gets no row.  An empty edge
    table gives an empty result.
    """
    e = cut_lineage(edges.where(F.col(a) != F.col(b))
                    .select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct())
    labels = None
    while e.limit(1).count():
        par = _compress(cut_lineage(e.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("p"))))
        lo = par.select(F.col("node").alias("lo"), F.col("p").alias("plo"))
        hi = par.select(F.col("node").alias("hi"), F.col("p").alias("phi"))
        # every ``hi`` was hooked, so that join keeps all edges
        moved = e.join(hi, "hi").join(lo, "lo", "left").select(F.coalesce("plo", "lo").alias("x"), F.col("phi").alias("y"))
        e = cut_lineage(moved.where("x != y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
        if labels is None:
            labels = par.select("node", F.col("p").alias("component"))
        else:
            old = labels.join(par.select(F.col("node").alias("component"), "p"), "component", "left")
            labels = cut_lineage(old.select("node", F.coalesce("p", "component").alias("component"))
                                 .unionByName(par.select("node", F.col("p").alias("component"))))
    if labels is None:
        return e.select(F.col("lo").alias("node"), F.col("hi").alias("component"))
    roots = labels.select(F.col("component").alias("node")).distinct()
    return labels.unionByName(roots.withColumn("component", F.col("node")))
