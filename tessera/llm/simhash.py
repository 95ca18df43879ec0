"""SimHash near-duplicates by bit-sliced comparison.

``fingerprints`` reads whole texts.  ``close_fingerprints`` finds all pairs of
distinct fingerprints that differ in at most ``radius`` bits: the 64 bits are
cut into radius + 2 blocks, so at least two blocks of a linked pair agree, and
each pair of blocks gives one bucket table.  Inside a bucket fingerprints are
compared bit-sliced: their bits stand in vertical planes, one machine word per
64 fingerprints, and saturating carry-save counters add up the differing
planes of many fingerprints at once; a block of lanes is left as soon as all of
them exceed the radius.  Buckets over ``tile`` are split by further blocks of
the bits that are still free, then cut into tiles, so no task gets an unbounded
group and no pair is lost.  A bucket returns a spanning forest of its links,
never all of its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep, members, minimum_forest
from tessera.operators.components import connected_components
from tessera.sources.parallel import spread

TILE = 2048
LANES = 1 << 14


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the word shingles of a UTF-8 text (0 without words)."""
    w = text.lower().split()  # bytes: only A-Z change, only \x09-\x0D and \x20 split
    if not w:
        return 0
    joined = b" ".join(w)
    digest = xxhash.xxh64_digest
    if len(w) < words:
        hashes = digest(joined, 42)
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[:len(w) - words + 1].tolist(), ends[words - 1:].tolist())])
    n = len(hashes) // 8
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(np.frombuffer(hashes[at:at + (1 << 16)], np.uint8))
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed bigint), one row per input row.

    A null text counts as empty (fingerprint 0); a null id stays null.
    """
    def run(batches):
        for b in batches:
            out = []
            for t in b.column(1).cast(pa.binary()):
                v = t.as_py()
                f = fingerprint(v, words) if v else 0
                out.append(f - (1 << 64) if f >> 63 else f)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], names=["doc_id", "fp"])

    d = spread(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")))
    return d.mapInArrow(run, "doc_id bigint, fp bigint")


def fingerprint_of(text, words: int = 3):
    """Column of the fingerprints of a text column."""
    @F.pandas_udf("bigint")
    def of(col: pd.Series) -> pd.Series:
        out = np.array([fingerprint(t.encode(), words) if t else 0 for t in col], np.uint64)
        return pd.Series(out.view(np.int64))

    return of(text)


def _planes(v: np.ndarray) -> np.ndarray:
    """uint64 values as 64 vertical bit planes of uint64 words (lanes padded with zeros)."""
    n = -len(v) % 64
    bits = np.unpackbits(np.ascontiguousarray(v).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if n:
        bits = np.vstack([bits, np.zeros((n, 64), np.uint8)])
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


class Counter:
    """Bit-sliced saturating counters: adds planes, tells the lanes over ``radius``."""

    def __init__(self, shape, radius: int):
        self.radius = radius
        self.bits = [np.zeros(shape, np.uint64) for _ in range((radius + 1).bit_length())]
        self.over = np.zeros(shape, np.uint64)

    def add(self, plane: np.ndarray) -> None:
        carry = plane
        for c in self.bits:
            t = c & carry
            c ^= carry
            carry = t
        self.over |= carry

    def exceeds(self) -> np.ndarray:
        """Lanes whose count is above the radius, as a bit mask."""
        gt = np.zeros_like(self.over)
        eq = np.full_like(self.over, 0xFFFFFFFFFFFFFFFF)
        for k in reversed(range(len(self.bits))):
            if self.radius >> k & 1:
                eq &= self.bits[k]
            else:
                gt |= eq & self.bits[k]
                eq &= ~self.bits[k]
        return gt | self.over


def _within(planes, radius: int, shape) -> np.ndarray | None:
    """Mask of lanes with at most ``radius`` set planes; None if all exceed early."""
    c, full = Counter(shape, radius), np.uint64(0xFFFFFFFFFFFFFFFF)
    for k, p in enumerate(planes):
        c.add(p)
        if k % 8 == 7 and k > 8 and (c.exceeds() == full).all():
            return None
    return ~c.exceeds()


def _lanes(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(mask.view(np.uint8), axis=-1, bitorder="little")[..., :n]


def bucket_links(v: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of the values of one bucket within ``radius`` bits."""
    planes, n = _planes(v), len(v)
    ii, jj = [], []
    step = max(1, LANES // max(1, planes.shape[1]))
    for s in range(0, n, step):
        q = v[s:s + step]
        first = s // 64  # lanes before the block were compared from their own side
        sub = planes[:, first:]
        flip = [np.where(q >> np.uint64(k) & np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None] for k in range(64)]
        ok = _within((sub[k][None, :] ^ flip[k] for k in range(64)), radius, (len(q), sub.shape[1]))
        if ok is None:
            continue
        a, b = np.nonzero(_lanes(np.ascontiguousarray(ok), sub.shape[1] * 64))
        a, b = a + s, b + first * 64
        good = (a < b) & (b < n)
        ii.append(a[good])
        jj.append(b[good])
    z = np.zeros(0, np.int64)
    return (np.concatenate(ii), np.concatenate(jj)) if ii else (z, z)


def pair_lanes(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """For value pairs of many small buckets: which are within ``radius`` bits."""
    out = np.zeros(len(a), bool)
    for s in range(0, len(a), LANES * 16):
        x = a[s:s + LANES * 16] ^ b[s:s + LANES * 16]
        p = _planes(x)
        ok = _within(iter(p), radius, p.shape[1])
        if ok is not None:
            out[s:s + len(x)] = _lanes(ok, len(x)).astype(bool)
    return out


def _masks(free: int, blocks: int, agree: int) -> list[int]:
    """Bit masks of ``agree`` of ``blocks`` equal cuts of the bits set in ``free``."""
    pos = [k for k in range(64) if free >> k & 1]
    cuts = [sum(1 << int(k) for k in c) for c in np.array_split(pos, blocks)]
    return [sum(c) for c in combinations(cuts, agree)]


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def _keyed(df: DataFrame, masks: list[int]) -> DataFrame:
    e = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks])
    return df.select("fp", F.explode(e).alias("e")).select("fp", "e.mask", "e.key")


def close_fingerprints(fps: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Distinct ``fp`` -> ``a, b``: edges whose components are those of all pairs
    that differ in at most ``radius`` bits."""
    if not 0 <= radius <= 14:
        raise ValueError("radius must be 0 to 14")
    blocks = radius + 2
    top = _masks((1 << 64) - 1, blocks, 2)
    rows = _keyed(fps, top)
    sizes = rows.groupBy("mask", "key").count().where("count > 1")
    shared = keep(rows.join(sizes, ["mask", "key"]))
    small = shared.where(F.col("count") <= tile).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    # a larger bucket: two blocks of the bits that are still free must agree as well
    sub = [(m, [m | s for s in _masks(((1 << 64) - 1) & ~m, blocks, 2)]) for m in top]
    large = shared.where(F.col("count") > tile)
    finer = F.array(*[F.struct(F.lit(_signed(m)).alias("top"), F.lit(_signed(s)).alias("mask")) for m, ss in sub for s in ss])
    fine = (large.withColumn("e", F.explode(F.filter(finer, lambda x: x["top"] == F.col("mask"))))
            .select("fp", F.col("e.top").alias("top"), F.col("e.mask").alias("mask"),
                    F.col("fp").bitwiseAND(F.col("e.mask")).alias("key")))
    n2 = fine.groupBy("top", "mask", "key").count().where("count > 1")
    s = F.ceil(F.col("count") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), s).cast("int")
    tiles = (fine.join(n2, ["top", "mask", "key"]).withColumn("s", s).withColumn("o", own)
             .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
             .groupBy("top", "mask", "key", F.least("o", "x").alias("ti"), F.greatest("o", "x").alias("tj"))
             .agg(F.collect_list("fp").alias("fps")).select("fps"))

    def run(batches):
        for batch in batches:
            col = batch.column(0)
            flat = np.asarray(col.flatten(), np.int64).view(np.uint64)
            off = np.asarray(col.offsets, np.int64)
            off = off - off[0]
            ea, eb, pi, pj = [], [], [], []
            waiting = 0

            def small_pairs():
                if not pi:
                    return
                i, j = np.concatenate(pi), np.concatenate(pj)
                ok = pair_lanes(flat[i], flat[j], radius)
                ea.append(flat[i[ok]])
                eb.append(flat[j[ok]])
                pi.clear()
                pj.clear()

            size = np.diff(off)
            for m in np.unique(size[size > 1]):
                at = off[:-1][size == m]
                if m <= 64:
                    i, j = np.triu_indices(m, 1)
                    for s0 in range(0, len(at), max(1, (1 << 20) // len(i))):
                        part = at[s0:s0 + max(1, (1 << 20) // len(i))]
                        pi.append((part[:, None] + i[None, :]).ravel())
                        pj.append((part[:, None] + j[None, :]).ravel())
                        waiting += len(pi[-1])
                        if waiting >= 1 << 20:
                            small_pairs()
                            waiting = 0
                    continue
                for s0 in at:
                    v = np.unique(flat[s0:s0 + m])
                    i, j = bucket_links(v, radius)
                    lab = minimum_forest(len(v), i, j)
                    hit = lab != np.arange(len(v))
                    ea.append(v[hit])
                    eb.append(v[lab[hit]])
            small_pairs()
            a = np.concatenate(ea) if ea else np.zeros(0, np.uint64)
            b = np.concatenate(eb) if eb else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return small.unionByName(tiles).mapInArrow(run, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits.  Rows with a null doc_id get a fingerprint and
    the component of their fingerprint (null if no member has an id); repeated
    rows give repeated results; an empty table gives none.
    """
    return simhash_rows(docs, words, radius, id_col, text_col).select("doc_id", "fp", "component_id")


def simhash_rows(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``simhash_groups``, with ``component``: components of one smallest doc_id
    (an id with several texts) differ in it."""
    fps = keep(fingerprints(docs, words, id_col, text_col))
    nodes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comp = connected_components(close_fingerprints(nodes.select("fp"), radius))
    own = members(comp, nodes, "fp")
    ids = own.groupBy("component").agg(F.min("first").alias("component_id"))
    named = own.join(ids, "component").select("fp", "component", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component", "component_id")
