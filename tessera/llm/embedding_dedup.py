"""Embedding near-duplicates by collision-counting projections.

Unit vectors are linked at cosine >= ``threshold``, that is at most ``radius``
apart.  Every vector is projected on many random directions.  A pair within the
radius lies within a window around either of its values in almost all of these
one-dimensional projections, a random pair in few of them: a pair is verified
if it collides in at least the number of windows that a binomial tail gives for
``RECALL``.  A window on one projection alone holds a constant share of all
pairs, so the projections are sorted and counted inside cells: ``depth``
projections cut into cells give one table, and ``tables`` of them are used, both
computed from the number of vectors and the recall wanted at the threshold.

Groups of very similar vectors become balls first: everything within half the
linking angle of a leader is linked with everything else there, and two balls
whose centres and radii prove all or no links need no comparison.  The other
candidate pairs of balls are compared by double-precision cosines, block by
block.  So copies are counted, not expanded into pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep
from tessera.operators.components import connected_components
from tessera.session import cut_lineage

THRESHOLD = 0.95
RECALL = 0.997
CELL = 2.0
POOL = 24
STEP = 1 / 32
ROUNDS = 3
TILE = 512
BLOCK = 256
SEED = 20_11


# ------------------------------------------------------------------ calibration
def _same_cell(r: float, w: float) -> float:
    """Chance that two points r apart share a cell of width w of a Gaussian projection."""
    t = w / r
    return 1 - math.erfc(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def calibrate(n: int, radius: float, recall: float = RECALL) -> tuple[int, int]:
    """(depth, tables): about a constant number of random partners for each vector
    and table, and at least ``recall`` for a pair just at the radius."""
    near, far = _same_cell(radius, CELL), _same_cell(math.sqrt(2), CELL)
    depth = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)) + 1)
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - near ** depth * recall))


def least_count(pool: int, p: float, miss: float = 1e-4) -> int:
    """Largest count that a pair with collision chance p reaches but for ``miss``."""
    tail = 0.0
    for k in range(pool + 1):
        tail += math.comb(pool, k) * p ** k * (1 - p) ** (pool - k)
        if tail > miss:
            return k
    return pool


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


# ------------------------------------------------------------------ vectors
def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v, dim``: one row per id; v is null for vectors that link with nothing."""
    rows = vectors.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("vec_id")).agg(F.min(vec_col).alias("e"))

    def run(batches):
        for b in batches:
            out, dims = [], []
            for e in b.column(1):
                x = np.array(e.as_py() if e.is_valid else [], dtype=np.float64)  # a null component becomes NaN
                top = np.abs(x).max() if len(x) else 0.0
                ok = np.isfinite(x).all() and 0 < top < np.inf
                if ok:
                    x = x / top
                    x = x / np.sqrt(x @ x)
                out.append(x.tobytes() if ok else None)
                dims.append(len(x) if ok else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], names=["vec_id", "v", "dim"])

    return rows.mapInArrow(run, "vec_id bigint, v binary, dim int")


def _matrix(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in col), np.float64).reshape(-1, dim)


def _by_dim(b: pa.RecordBatch, v: int, d: int):
    dims = np.asarray(b.column(d))
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, _matrix(b.column(v).take(pa.array(at)), int(dim))


def cell_keys(x: np.ndarray, depth: int, tables: int, seed: int) -> np.ndarray:
    """Cell of each row in each table, hashed to 64 bits (rows x tables)."""
    dim = x.shape[1]
    shift = np.random.default_rng([seed, dim, 1]).random(depth * tables) * CELL
    c = np.floor((x @ directions(dim, depth * tables, seed) + shift) / CELL).astype(np.int64).astype(np.uint64)
    mult = np.random.default_rng([seed, 2]).integers(1, 1 << 63, depth, dtype=np.uint64) | np.uint64(1)
    h = (c.reshape(len(x), tables, depth) * mult).sum(axis=2, dtype=np.uint64) + np.uint64(dim * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(31)
    return (h * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _keys(vs: DataFrame, depth: int, tables: int, seed: int) -> DataFrame:
    """``vec_id, keys`` of ``vec_id, v, dim``."""
    def run(batches):
        for b in batches:
            for dim, at, x in _by_dim(b, 1, 2):
                k = cell_keys(x, depth, tables, seed)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(list(k), pa.list_(pa.int64()))], names=["vec_id", "keys"])
    return vs.select("vec_id", "v", "dim").mapInArrow(run, "vec_id bigint, keys array<bigint>")


# ------------------------------------------------------------------ balls
def balls(vs: DataFrame, threshold: float, depth: int) -> DataFrame:
    """``vec_id, ball`` of all valid vectors: within a ball all pairs are linked.

    Each round deals the vectors that stand alone, and the leaders, to the cells
    of a table of its own; the smallest id of a cell takes in those that stand
    alone within half the linking angle.  A leader is the smallest id of its ball.
    """
    close = math.cos(math.acos(threshold) / 2) + 1e-9

    def near(batches):
        for b in batches:
            v, lv = b.column(1), b.column(3)
            ok = [len(p) == len(q) and float(np.frombuffer(p, np.float64) @ np.frombuffer(q, np.float64)) >= close
                  for p, q in zip(v.to_pylist(), lv.to_pylist())]
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(2).filter(ok)], names=["vec_id", "ball"])

    active = vs.select("vec_id", "v", "dim").withColumn("leads", F.lit(False))
    taken = None
    for r in range(ROUNDS):
        keyed = cut_lineage(active.join(_keys(active, depth, 1, SEED + 100 + r), "vec_id").withColumn("key", F.col("keys")[0]))
        lead = keyed.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        lead = lead.join(keyed.select("key", "vec_id", "v"), ["key", "vec_id"]).select("key", F.col("vec_id").alias("leader"), F.col("v").alias("lv"))
        pairs = keyed.where("NOT leads").join(lead, "key").where("vec_id <> leader").select("vec_id", "v", "leader", "lv")
        got = cut_lineage(pairs.mapInArrow(near, "vec_id bigint, ball bigint"))
        taken = got if taken is None else taken.unionByName(got)
        heads = got.select(F.col("ball").alias("vec_id")).distinct().withColumn("now", F.lit(True))
        active = cut_lineage(keyed.join(got, "vec_id", "left_anti").join(heads, "vec_id", "left")
                      .select("vec_id", "v", "dim", (F.col("leads") | F.coalesce("now", F.lit(False))).alias("leads")))
    return taken.unionByName(active.select("vec_id", F.col("vec_id").alias("ball")))


def _centres(member: DataFrame, vs: DataFrame) -> DataFrame:
    """``ball, c, dim, size, r``: unit mean of a ball and the largest angle of a member to it."""
    def sums(batches):
        for b in batches:
            ball = np.asarray(b.column(0))
            for dim, at, x in _by_dim(b, 1, 2):
                u, which = np.unique(ball[at], return_inverse=True)
                s = np.zeros((len(u), dim))
                np.add.at(s, which, x)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array([y.tobytes() for y in s], pa.binary()), pa.array([dim] * len(u), pa.int32()), pa.array(np.bincount(which))],
                                                 names=["ball", "s", "dim", "size"])

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        c = np.sum([np.frombuffer(x, np.float64) for x in pdf["s"]], axis=0)
        return pd.DataFrame({"ball": pdf["ball"].iloc[:1], "c": [(c / np.sqrt(c @ c)).tobytes()], "dim": pdf["dim"].iloc[:1], "size": [pdf["size"].sum()]})

    def angle(batches):
        for b in batches:
            a = [math.acos(max(-1.0, min(1.0, float(np.frombuffer(p, np.float64) @ np.frombuffer(q, np.float64))))) for p, q in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(a, pa.float64())], names=["ball", "a"])

    rows = member.join(vs, "vec_id").select("ball", "v", "dim")
    sizes = member.groupBy("ball").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(sizes, "ball")
    alone = rows.where("n = 1").select("ball", F.col("v").alias("c"), "dim", F.lit(1).cast("bigint").alias("size"), F.lit(0.0).alias("r"))
    many = keep(rows.where("n > 1").select("ball", "v", "dim"))
    # one row of each ball and Arrow batch meets here
    c = keep(many.mapInArrow(sums, "ball bigint, s binary, dim int, size bigint").groupBy("ball").applyInPandas(mean, "ball bigint, c binary, dim int, size bigint"))
    r = many.join(c.select("ball", "c"), "ball").select("ball", "v", "c").mapInArrow(angle, "ball bigint, a double").groupBy("ball").agg((F.max("a") + 1e-9).alias("r"))
    return alone.unionByName(c.join(r, "ball"))


# ------------------------------------------------------------------ candidates
def _counted(lists: DataFrame, radius: float) -> DataFrame:
    """Pairs of the balls of each list that collide in enough windows of the pool."""
    window = 2 * radius
    ask = least_count(POOL, math.erf(2 / math.sqrt(2)))

    def run(batches):
        for b in batches:
            rows = b.column(0)
            off, items = np.asarray(rows.offsets, np.int64), rows.values
            ball, part = np.asarray(items.field("ball")), np.asarray(items.field("part"))
            wide = np.asarray(items.field("r"))
            q = np.frombuffer(b"".join(items.field("q").to_pylist()), np.int8).reshape(-1, POOL).astype(np.float32) * STEP
            ti, tj = np.asarray(b.column(1)), np.asarray(b.column(2))
            oa, ob = [], []
            for k in range(len(rows)):
                s, e = off[k], off[k + 1]
                order = s + np.argsort(q[s:e, 0], kind="stable")
                x, w = q[order], 6 * np.sin(wide[order] / 2)  # three deviations of a member's offset
                reach = 3.5 * radius + w + (w.max() if len(w) else 0)
                # sorted first projection: each query's window, forward from its own place
                hi = np.searchsorted(x[:, 0], x[:, 0] + reach, side="right")
                own = np.arange(e - s)
                ahead = hi - own - 1
                i = np.repeat(own, ahead)
                j = np.arange(len(i)) - np.repeat(np.cumsum(ahead) - hi, ahead)
                if ti[k] != tj[k]:
                    cross = part[order][i] != part[order][j]
                    i, j = i[cross], j[cross]
                for c in range(0, len(i), 1 << 18):
                    a, z = i[c:c + (1 << 18)], j[c:c + (1 << 18)]
                    hits = (np.abs(x[a] - x[z]) <= (window + 2 * STEP + w[a] + w[z])[:, None]).sum(axis=1)
                    good = hits >= ask
                    p, r = ball[order[a[good]]], ball[order[z[good]]]
                    oa.append(np.minimum(p, r))
                    ob.append(np.maximum(p, r))
            a = np.concatenate(oa) if oa else np.zeros(0, np.int64)
            z = np.concatenate(ob) if ob else np.zeros(0, np.int64)
            both = np.unique(np.stack([a, z], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return lists.mapInArrow(run, "a bigint, b bigint").where("a < b").distinct()


def candidates(vs: DataFrame, member: DataFrame, centre: DataFrame, depth: int, tables: int, radius: float, tile: int = TILE) -> DataFrame:
    """``a < b``: pairs of balls that share a cell and collide in enough windows."""
    def pool(batches):
        for b in batches:
            for dim, at, x in _by_dim(b, 1, 2):
                q = np.clip(np.rint(x @ directions(dim, POOL, SEED + 7) / STEP), -127, 127).astype(np.int8)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(3).take(pa.array(at)), pa.array([y.tobytes() for y in q], pa.binary())], names=["ball", "r", "q"])

    info = centre.select("ball", "c", "dim", "r").mapInArrow(pool, "ball bigint, r double, q binary")
    cells = (_keys(vs, depth, tables, SEED).join(member, "vec_id")
             .select("ball", F.posexplode("keys").alias("t", "key")).distinct())
    cells = keep(cells)
    n = cells.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    s = F.ceil(F.col("n") / tile).cast("int")
    dealt = (cells.join(n, ["t", "key"]).withColumn("s", s).withColumn("part", F.pmod(F.xxhash64("ball"), F.col("s")).cast("int"))
             .join(info, "ball").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("s") - 1))))
    lists = (dealt.groupBy("t", "key", F.least("part", "x").alias("ti"), F.greatest("part", "x").alias("tj"))
             .agg(F.collect_list(F.struct("ball", "part", "r", "q")).alias("l")).select("l", "ti", "tj"))
    return _counted(lists, radius)


# ------------------------------------------------------------------ links
def _angles(pairs: DataFrame, centre: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            g = [math.acos(max(-1.0, min(1.0, float(np.frombuffer(p, np.float64) @ np.frombuffer(q, np.float64))))) if len(p) == len(q) else 9.0
                 for p, q in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *b.columns[6:], pa.array(g, pa.float64())], names=["a", "b", "ra", "rb", "na", "nb", "g"])

    side = lambda x: centre.select(F.col("ball").alias(x), F.col("c").alias(f"c{x}"), F.col("r").alias(f"r{x}"), F.col("size").alias(f"n{x}"))
    j = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "ca", "cb", "na", "nb")
    return j.mapInArrow(run, "a bigint, b bigint, ra double, rb double, na bigint, nb bigint, g double")


def _compared(unsure: DataFrame, member: DataFrame, vs: DataFrame, threshold: float) -> DataFrame:
    """``vec_id, links, a, b``: links of each vector of unsure pairs of balls, by cosines."""
    sizes = member.groupBy("ball").agg(F.count(F.lit(1)).alias("n"))
    blocks = keep(member.join(sizes, "ball").join(vs, "vec_id")
                  .groupBy("ball", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / BLOCK)).alias("block"))
                  .agg(F.collect_list(F.struct("vec_id", "v")).alias("l")).select("ball", "l"))

    def run(batches):
        for b in batches:
            out = []
            for k in range(b.num_rows):
                one, two = b.column(2)[k].as_py(), b.column(3)[k].as_py()
                x = np.frombuffer(b"".join(i["v"] for i in one), np.float64).reshape(len(one), -1)
                y = np.frombuffer(b"".join(i["v"] for i in two), np.float64).reshape(len(two), -1)
                ok = x @ y.T >= threshold
                ids = [i["vec_id"] for i in one] + [i["vec_id"] for i in two]
                out += [(i, int(c), b.column(0)[k].as_py(), b.column(1)[k].as_py()) for i, c in zip(ids, [*ok.sum(axis=1), *ok.sum(axis=0)]) if c]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["vec_id", "links", "a", "b"])

    j = (unsure.select("a", "b").join(blocks.select(F.col("ball").alias("a"), F.col("l").alias("la")), "a")
         .join(blocks.select(F.col("ball").alias("b"), F.col("l").alias("lb")), "b"))
    return j.select("a", "b", "la", "lb").mapInArrow(run, "vec_id bigint, links bigint, a bigint, b bigint")


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors of different lengths, link with nothing.  Rows of one vec_id are one
    vector (the smallest array); rows with a null vec_id take no part.  An empty
    table gives an empty result.
    """
    every = cut_lineage(unit_vectors(vectors, id_col, vec_col))
    vs = every.where("v IS NOT NULL")
    theta = math.acos(threshold)
    radius = math.sqrt(2 - 2 * threshold)
    depth, tables = calibrate(vs.count(), radius)
    member = cut_lineage(balls(vs, threshold, depth))
    centre = cut_lineage(_centres(member, vs))
    g = cut_lineage(_angles(candidates(vs, member, centre, depth, tables, radius), centre))
    full = g.where(F.col("g") + F.col("ra") + F.col("rb") <= theta - 1e-7)
    unsure = g.where((F.col("g") + F.col("ra") + F.col("rb") > theta - 1e-7) & (F.col("g") - F.col("ra") - F.col("rb") <= theta + 1e-7))
    some = cut_lineage(_compared(unsure, member, vs, threshold))
    edges = full.select("a", "b").unionByName(some.select("a", "b").distinct())
    comp = connected_components(edges, "a", "b").select(F.col("node").alias("ball"), "component")
    whole = (full.select(F.col("a").alias("ball"), F.col("nb").alias("k")).unionByName(full.select(F.col("b").alias("ball"), F.col("na").alias("k")))
             .groupBy("ball").agg(F.sum("k").alias("whole")))
    own = some.groupBy("vec_id").agg(F.sum("links").alias("own"))
    info = centre.select("ball", "size").join(whole, "ball", "left").join(comp, "ball", "left")
    linked = (member.join(info, "ball").join(own, "vec_id", "left")
              .select("vec_id", (F.col("size") - 1 + F.coalesce("whole", F.lit(0)) + F.coalesce("own", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "ball").alias("component_id")))
    rest = every.where("v IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
