"""Near-duplicate detection on sets: MinHash signatures, banded LSH,
exact Jaccard verification, exact prefix-filter similarity join, scoring.

Output contract of the pair jobs (``near_dup_pairs``, ``exact_similar_pairs``):
documents with an identical shingle set form a *content group* whose
representative is its lowest id.  Each other member is reported once as the
edge ``(representative, member, 1.0)``; pairs between different contents
are reported between representatives when their Jaccard similarity is at or
above the threshold.  The full pair list is the expansion of these edges;
it is quadratic in group size, so it is never materialised.  Documents with
an empty shingle set (no word, or null text) are excluded:
Jaccard is undefined for two empty sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import HASH_MAX, hash_coefficients, hex_int
from tessera.functions.text import set_key, shingle_ids, words
from tessera.operators import set_join
from tessera.operators.components import connected_components
from tessera.operators.joins import DEFAULT_BLOCK, _block, _look_up, bucket_cross_pairs, bucket_self_pairs
from tessera.operators.partial import collect_sums
from tessera.session import cut_lineage, materialize, materialize_sets, small_batches
from tessera.sources.parallel import spread_rows

# Default banding: r=5 rows per band, b=20 bands (100 hashes): a pair at
# Jaccard 0.85 is missed with probability (1-0.85^5)^20 ~ 8e-6.
DEFAULT_R = 5
DEFAULT_B = 20
DEFAULT_THRESHOLD = 0.85
DEFAULT_SEED = 42
BROADCAST_IDS = 2_000_000  # tables of document ids are broadcast only below this row count
#: Counters that order the ids of sets by frequency, at most, and how many travel in one array.
SLOTS = 1 << 20
SLOT_CHUNK = 1 << 14


# --------------------------------------------------------------------- G2
# Fixed tokenisation rule (shared with the SQL oracles): lower-case, split on
# runs of the whitespace class [ \t\n\x0b\f\r], drop empty tokens; a shingle
# is k tokens joined by one space; its id is the first 60 bits of md5.  A text
# with fewer tokens has one shingle of all of them.
#: Text bytes, or ids of sets, that a Python step works on: a batch is cut between rows,
#: so a worker's temporary arrays do not grow with the rows of a batch.
STEP_BYTES = 4 << 20
STEP_IDS = 1 << 19


def _shingle_text(text: str, k: int) -> np.ndarray:
    w = text.lower().encode("utf-8").split()  # bytes split at the class above
    if not w:
        return np.zeros(0, dtype=np.int64)
    grams = zip(*(w[j:] for j in range(k))) if len(w) >= k else [w]
    md5 = hashlib.md5
    d = b"".join([md5(g).digest() for g in set(map(b" ".join, grams))])
    return np.unique((np.frombuffer(d, dtype=">u8")[::2] >> np.uint64(4)).astype(np.int64))


def _cuts(off: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` units between offsets ``off`` (one row at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column as its values and n + 1 offsets; null counts as empty."""
    n = np.asarray(pc.fill_null(pc.list_value_length(col), 0), dtype=np.int64)
    return np.asarray(col.flatten(), dtype=np.int64), np.concatenate([[0], np.cumsum(n)])


def shingle(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text",
            with_key: bool = False) -> DataFrame:
    """text -> ``doc_id, shingles`` (sorted distinct 60-bit k-word shingle ids).

    Null texts and texts without words give no row.  ``with_key`` adds
    ``skey``, a content key equal for equal sets (md5 of the sorted ids).
    Runs as ``mapInArrow``, some texts of a batch at a time: the operator is opaque to
    filter pushdown, so later filters never re-run the tokeniser.
    """
    d = spread_rows(docs.where(F.col(text_col).isNotNull())
                    .select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), docs)

    def _batches(it):
        for batch in it:
            size = np.asarray(pc.binary_length(batch.column(1)), dtype=np.int64)
            for i, j in _cuts(np.concatenate([[0], np.cumsum(size)]), STEP_BYTES):
                arrs = [_shingle_text(t, k) for t in batch.column(1).slice(i, j - i).to_pylist()]
                at = [m for m, a in enumerate(arrs) if len(a)]
                if not at:
                    continue
                arrs = [arrs[m] for m in at]
                off = np.concatenate([[0], np.cumsum([len(a) for a in arrs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(at, pa.int64())),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(arrs))),
                     pa.array([hashlib.md5(a.tobytes()).hexdigest() for a in arrs], pa.string())],
                    names=["doc_id", "shingles", "skey"])

    s = d.mapInArrow(_batches, "doc_id bigint, shingles array<bigint>, skey string")
    return s if with_key else s.drop("skey")


def shingle_jvm(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Same sets with built-in expressions only (kept for plans that must stay in the JVM)."""
    w = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("_w"))
    return (w.where(F.size("_w") > 0)
            .select("doc_id", F.array_sort(shingle_ids(F.col("_w"), k)).alias("shingles")))


# --------------------------------------------------------------------- H1 / D3
def minhash_udf(n_hashes: int, seed: int = DEFAULT_SEED):
    """Arrow MinHash: sig_i = min_x ((a_i x + b_i) mod 2^64) >> 3.

    The ids of some sets are hashed together, one function after another in blocks that
    stay in the processor's cache; the minimum per set is a ``minimum.reduceat`` over the
    sets' offsets.  Shifting keeps the order, so only minima are shifted.  Empty sets
    give an all-maximum signature.
    """
    a, b = hash_coefficients(n_hashes, seed)
    chunk = 32768

    def _signatures(x: np.ndarray, off: np.ndarray, out: np.ndarray) -> None:
        rows = np.flatnonzero(np.diff(off))
        owner = np.repeat(rows, np.diff(off)[rows])
        h = np.empty(min(chunk, len(x)), dtype=np.uint64)
        for s0 in range(0, len(x), chunk):
            part, own = x[s0:s0 + chunk].astype(np.uint64), owner[s0:s0 + chunk]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            at, v = own[starts], h[:len(part)]
            mins = np.empty((len(starts), n_hashes), dtype=np.uint64)
            for i in range(n_hashes):
                np.multiply(part, a[i], out=v)
                np.add(v, b[i], out=v)
                mins[:, i] = np.minimum.reduceat(v, starts)
            out[at] = np.minimum(out[at], (mins >> np.uint64(3)).astype(np.int64))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def _mh(sets: pa.Array) -> pa.Array:
        flat, off = _lists(sets)
        out = np.full((len(sets), n_hashes), HASH_MAX, dtype=np.int64)
        for i, j in _cuts(off, STEP_IDS):
            _signatures(flat[off[i]:off[j]], off[i:j + 1] - off[i], out[i:j])
        ends = np.arange(0, out.size + 1, n_hashes, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return _mh


def minhash(sets: DataFrame, n_hashes: int = DEFAULT_R * DEFAULT_B, seed: int = DEFAULT_SEED,
            col: str = "shingles") -> DataFrame:
    """``doc_id, shingles`` -> ``doc_id, sig`` (array<bigint> of n_hashes)."""
    return sets.select("doc_id", minhash_udf(n_hashes, seed)(F.col(col)).alias("sig"))


# --------------------------------------------------------------------- G3 / B8
def band_key_exprs(sig: Column, r: int, b: int) -> list[Column]:
    """Band keys: the first 60 bits of md5 over the r values of a band."""
    return [hex_int(F.array_join(F.slice(sig, k * r + 1, r).cast("array<string>"), ","), 15) for k in range(b)]


def bands(sigs: DataFrame, r: int = DEFAULT_R, b: int = DEFAULT_B, seed: int = DEFAULT_SEED) -> DataFrame:
    """``doc_id, sig`` -> one row per (doc, band): ``doc_id, band, key``."""
    keys = F.array(*band_key_exprs(F.col("sig"), r, b))
    return sigs.select("doc_id", F.posexplode(keys).alias("band", "key"))


# --------------------------------------------------------------------- S1
def jaccard(a: Column, b: Column) -> Column:
    """|A & B| / |A | B| for two distinct-element arrays (inclusion-exclusion)."""
    inter = F.size(F.array_intersect(a, b))
    return inter / (F.size(a) + F.size(b) - inter)


# --------------------------------------------------------------------- collapse
def content_groups(sets: DataFrame) -> DataFrame:
    """``doc_id, shingles[, skey]`` -> ``doc_id, rep`` (rep = lowest id with the same set).

    Uses ``skey`` when the shingle stage produced it (md5 of the sorted
    ids), else computes a key from the array.
    """
    key = F.col("skey") if "skey" in sets.columns else set_key(F.col("shingles"))
    keyed = sets.select("doc_id", key.alias("_k"))
    reps = keyed.groupBy("_k").agg(F.min("doc_id").alias("rep"))
    return keyed.join(reps, "_k").select("doc_id", "rep")


def collapse_identical(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (representative sets, identical-content edges rep->member).

    The ids that represent nothing, usually few, leave by an anti join, so that the
    sets themselves need not be shuffled."""
    groups = materialize(content_groups(sets))
    star = (groups.where(F.col("doc_id") != F.col("rep"))
            .select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"),
                    F.lit(1.0).alias("jaccard")))
    own = groups.where(F.col("doc_id") == F.col("rep")).select("doc_id")
    others = materialize(star.select(F.col("doc_b").alias("doc_id")).distinct().join(own, "doc_id", "left_anti"))
    reps = sets.where(F.col("doc_id").isNotNull()).join(_small(others), "doc_id", "left_anti")
    return reps, star


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` (persisted), to be broadcast where they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


# --------------------------------------------------------------------- C1 / D13
def candidate_pairs(band_rows: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Distinct ``doc_a < doc_b`` sharing any (band, key) bucket (skew-tiled).

    The join persists the band rows (memory+disk, recomputable) for the
    bucket-size count and both sides.
    """
    p = bucket_self_pairs(band_rows, ["band", "key"], "doc_id", block=block)
    return p.select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b")).distinct()


# --------------------------------------------------------------------- C2 / B1
#: Sets of a cluster that are compared in one place; larger clusters are tiled.
VERIFY_BLOCK = 256
#: How many pairs away from a document its cluster's smallest document is looked for.
VERIFY_STEPS = 3


def _places(pairs: DataFrame, cost: float) -> tuple[DataFrame, DataFrame]:
    """``doc_a, doc_b, slot`` of checkpointed pairs dealt into places, and the places ``doc_id, place``
    where a document is needed; a place gets about ``set_join.COMPARED_IDS`` ids of
    sets that have ``cost`` on average.

    A pair belongs to the smallest document that lies a few pairs from either end, so nearly
    all pairs of a cluster go together; a cluster of many documents is cut into blocks
    and compared by pairs of blocks.
    """
    edge = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    near = pairs.select(F.inline(F.array(edge("doc_a", "doc_b"), edge("doc_b", "doc_a"), edge("doc_a", "doc_a"), edge("doc_b", "doc_b"))))
    label = near.groupBy("x").agg(F.min("y").alias("g"))
    for _ in range(VERIFY_STEPS - 1):
        label = near.join(label.select(F.col("x").alias("y"), "g"), "y").groupBy("x").agg(F.min("g").alias("g"))
    of = lambda c: label.select(F.col("x").alias(c), F.col("g").alias(f"_{c}"))
    lead = cut_lineage(pairs.join(of("doc_a"), "doc_a").join(of("doc_b"), "doc_b").select("doc_a", "doc_b", F.least("_doc_a", "_doc_b").alias("_g")))
    ends = F.explode(F.array("doc_a", "doc_b")).alias("doc_id")
    n = cut_lineage(lead.select("_g", ends).distinct().groupBy("_g").agg(F.count(F.lit(1)).alias("_n")))
    hot = n.where(F.col("_n") > VERIFY_BLOCK).select("_g", F.ceil(F.col("_n") / VERIFY_BLOCK).cast("int").alias("_s"))
    dealt = _look_up(lead, hot, ["_g"], ["_s"]).withColumn("_x", _block("doc_a", "_s")).withColumn("_y", _block("doc_b", "_s"))
    ids = (n.agg(F.sum("_n")).first()[0] or 0) * cost
    places = max(pairs.sparkSession.sparkContext.defaultParallelism, -int(-ids // set_join.COMPARED_IDS))
    place = F.pmod(F.xxhash64("_g", F.least("_x", "_y"), F.greatest("_x", "_y")), F.lit(places)).alias("slot")
    dealt = cut_lineage(dealt.select("doc_a", "doc_b", place))
    return dealt, cut_lineage(dealt.select(F.col("slot").alias("place"), ends).distinct())


def possible_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs ``doc_a < doc_b`` that the parity maps of their sets do not rule out:
    none at or above the threshold is lost, pairs that share few ids by chance are."""
    pairs = cut_lineage(pairs.select("doc_a", "doc_b").distinct())
    ids = cut_lineage(pairs.select(F.explode(F.array("doc_a", "doc_b")).alias("doc_id")).distinct())

    def maps(batches):
        for b in batches:
            flat, off = _lists(b.column(1))
            for i, j in _cuts(off, STEP_IDS):
                size = np.diff(off[i:j + 1])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(size), set_join.parity_maps(size, off[i:j + 1], flat[off[i]:off[j]])],
                                                 names=["doc_id", "n", "map"])
    mapped = materialize_sets(sets.select("doc_id", "shingles").join(_small(ids), "doc_id", "left_semi").mapInArrow(maps, "doc_id bigint, n bigint, map binary"))
    mean = mapped.agg(F.avg(F.length("map") / 8)).first()[0] or 0
    dealt, sent_to = _places(pairs, mean)
    sent = mapped.join(_small(sent_to), "doc_id").select("place", "doc_id", "n", "map")
    return dealt.groupBy("slot").cogroup(sent.groupBy("place")).applyInArrow(set_join.possible(threshold), "doc_a bigint, doc_b bigint")


def mean_size(sets: DataFrame) -> float:
    """Ids of a set on average."""
    return sets.agg(F.avg(F.size("shingles"))).first()[0] or 0


def verify_pairs(pairs: DataFrame, sets: DataFrame, mean: float | None = None) -> DataFrame:
    """Attach exact Jaccard to ``doc_a < doc_b``; only the sets of documents that stand in a
    pair are shuffled, and once for each cluster of similar documents, not for each pair.
    ``mean`` is the size of a set, about, where counting it would read a large table."""
    pairs = cut_lineage(pairs.select("doc_a", "doc_b"))
    dealt, sent_to = _places(pairs, mean_size(sets) if mean is None else mean)
    sent = sets.select("doc_id", "shingles").join(_small(sent_to), "doc_id").select("place", "doc_id", "shingles")
    return dealt.groupBy("slot").cogroup(sent.groupBy("place")).applyInArrow(
        lambda pairs, sets: set_join.compare(pairs, sets), "doc_a bigint, doc_b bigint, jaccard double")


def threshold_filter(pairs: DataFrame, threshold: float) -> DataFrame:
    """Keep pairs with Jaccard >= threshold (inclusive)."""
    return pairs.where(F.col("jaccard") >= F.lit(threshold))


# --------------------------------------------------------------------- L1
def near_dup_pairs_from_sets(sets: DataFrame, r: int = DEFAULT_R, b: int = DEFAULT_B,
                             threshold: float = DEFAULT_THRESHOLD, seed: int = DEFAULT_SEED,
                             block: int = DEFAULT_BLOCK, collapse: bool = True) -> DataFrame:
    """MinHash + banded LSH + exact verification on ``doc_id, shingles``; ``collapse=False``
    takes sets that are representatives already."""
    reps, star = _representatives(sets, collapse)
    sig = minhash(reps, r * b, seed)
    cands = candidate_pairs(bands(sig, r, b, seed), block)
    verified = threshold_filter(verify_pairs(cands, reps), threshold)
    return verified.unionByName(star) if star is not None else verified


def _representatives(sets: DataFrame, collapse: bool) -> tuple[DataFrame, DataFrame | None]:
    """(persisted sets to compare, edges of their copies or None).  Sets that are persisted
    already are not persisted again."""
    if not collapse and sets.is_cached:
        return sets, None
    sets = sets.where(F.size("shingles") > 0)
    reps, star = collapse_identical(sets) if collapse else (sets, None)
    return materialize_sets(reps), star


def near_dup_pairs(docs: DataFrame, k: int = 3, r: int = DEFAULT_R, b: int = DEFAULT_B,
                   threshold: float = DEFAULT_THRESHOLD, seed: int = DEFAULT_SEED,
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """Flagship: documents -> near-duplicate edges ``doc_a, doc_b, jaccard``.

    shingle -> collapse identical sets -> MinHash -> bands -> bucket self-join
    -> distinct -> exact Jaccard -> threshold.  The shingle table is
    persisted (memory+disk; recomputable from lineage if an executor dies)
    because it feeds the grouping, the signatures and the verification.
    """
    sets = materialize_sets(shingle(docs, k, with_key=True))
    pairs = near_dup_pairs_from_sets(sets, r, b, threshold, seed, block)
    sets.unpersist()  # the representatives are kept
    return pairs


# --------------------------------------------------------------------- exact join
def slot_counts(sets: DataFrame) -> np.ndarray:
    """How many ids of all sets fall on each counter (their low bits; ids are hashes).  The
    counters grow with the ids up to ``SLOTS``, so a task and the driver hold a fixed size."""
    total = sets.agg(F.sum(F.size("shingles").cast("bigint"))).first()[0] or 0
    slots = min(SLOTS, max(1 << 10, 1 << int(total).bit_length()))
    chunk = min(slots, SLOT_CHUNK)

    def part(b):
        flat, _ = _lists(b.column(0))
        n = np.bincount(flat & (slots - 1), minlength=slots).reshape(-1, chunk)
        return [(k, n[k].astype(np.float64)) for k in np.flatnonzero(n.any(axis=1)).tolist()]
    out = np.zeros((slots // chunk, chunk))
    with small_batches(sets.sparkSession):
        for k, v in collect_sums(sets.select("shingles"), part, slots).items():
            out[k] = v
    return out.ravel()


def _prefix_entries(batches, count: np.ndarray, threshold: float):
    """(ids, sizes, row of each entry, token, place) of the prefixes of some sets at a time."""
    mask = len(count) - 1
    for b in batches:
        flat, off = _lists(b.column(1))
        for s, e in _cuts(off, STEP_IDS):
            x, n = flat[off[s]:off[e]], np.diff(off[s:e + 1])
            owner = np.repeat(np.arange(e - s), n)
            order = np.lexsort((x, count[x & mask], owner))
            place = np.arange(len(x)) - np.repeat(off[s:e] - off[s], n)
            take = n - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1
            at = place < take[owner]
            yield b.column(0).slice(s, e - s), n, owner[at], x[order][at], place[at]


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, tok, n, i``: the first ``n - ceil(threshold n) + 1`` ids of every set of n ids
    in the order (:func:`slot_counts`, id), with the place i of each."""
    count = slot_counts(sets)

    def run(batches):
        for doc, n, own, tok, place in _prefix_entries(batches, count, threshold):
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(own)), pa.array(tok), pa.array(n[own].astype(np.int32)), pa.array(place.astype(np.int32))],
                                             names=["doc_id", "tok", "n", "i"])
    return sets.select("doc_id", "shingles").mapInArrow(run, "doc_id bigint, tok bigint, n int, i int")


def prefix_candidates(sets: DataFrame, threshold: float, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``doc_a < doc_b`` (some repeated) that share a token of their prefixes and pass the length and
    place filters.  Entries travel packed (:mod:`tessera.operators.set_join`); tokens with
    more than ``set_join.LISTED`` sets are paired by the tiled join."""
    count = slot_counts(sets)
    entries = int(count.sum() * (1 - threshold)) + 1
    groups = min(max(4 * sets.sparkSession.sparkContext.defaultParallelism, -(-entries // set_join.GROUP_ENTRIES)), 1 << 20)

    def send(batches):
        for doc, n, own, tok, place in _prefix_entries(batches, count, threshold):
            got = list(set_join.pack_entries(np.asarray(doc), n, own, tok, place, groups))
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in got], pa.int64()), pa.array([x for _, x in got], pa.binary())], names=["slot", "data"])
    found = (sets.where("doc_id IS NOT NULL").select("doc_id", "shingles").mapInArrow(send, set_join.SENT)
             .groupBy("slot").applyInArrow(set_join.find_candidates(threshold, min(block, set_join.LISTED)), set_join.FOUND))
    with small_batches(sets.sparkSession):
        found = cut_lineage(found)      # and the entries' files can go
    cands = found.where("tok IS NULL").select("doc_a", "doc_b")
    hot = found.where("tok IS NOT NULL").select("doc_id", "tok", "n", "i")
    if hot.limit(1).count():
        pairs = bucket_self_pairs(hot, ["tok"], "doc_id", block=block, extra=["n", "i"])
        lo, hi = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
        left = F.least(F.col("a_n") - F.col("a_i"), F.col("b_n") - F.col("b_i"))
        cands = cands.unionByName(pairs.where((lo >= F.lit(threshold) * hi - F.lit(1e-9)) & (left >= F.lit(threshold / (1 + threshold)) * (lo + hi) - F.lit(1e-6)))
                                  .select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b")))
    return cands


def exact_similar_pairs_from_sets(sets: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                                  block: int = DEFAULT_BLOCK, collapse: bool = True, kept: bool = False) -> DataFrame:
    """Exact Jaccard similarity self-join by prefix filtering.

    Tokens are ordered globally by (count of their counter, id).  Two sets with
    Jaccard >= t share a token among the first ``n - ceil(t n) + 1`` tokens
    of each, so joining on prefix tokens finds every qualifying pair, whatever the
    order; a length filter, the places of the shared token (which bound how many
    tokens can follow in both) and exact verification remove the rest.  Counters are
    at least the document frequency, so rare tokens mostly come
    first, which keeps prefix buckets small; hot buckets are tiled.  Only prefixes are
    shuffled, once, and packed.
    ``collapse=False`` reports plain pairs between all documents (identical
    groups then give all their pairs: use only where groups are small); ``kept`` says that
    these sets are cheap to read again, so that they are not persisted a second time.
    """
    reps, star = (sets, None) if kept else _representatives(sets, collapse)
    cands = possible_pairs(prefix_candidates(reps, threshold, block), reps, threshold)
    verified = threshold_filter(verify_pairs(cands, reps), threshold)
    return verified.unionByName(star) if star is not None else verified


def distinct_sets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, shingles, skey`` -> (``doc_id, shingles`` of each distinct content, its id taken
    from the content key; ``doc_id, id, c``: the rows ``c`` of a document ``id`` with that content).

    Rows of other documents with the content leave by an anti join, and only sets that
    their document holds twice are shuffled."""
    s = sets.where((F.size("shingles") > 0) & F.col("doc_id").isNotNull()).withColumn("_g", hex_int(F.col("skey"), 15))
    rows = s.groupBy(F.col("_g").alias("doc_id"), F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("c"))
    rows = cut_lineage(rows)
    first = rows.groupBy("doc_id").agg(F.min("id").alias("first"))
    spare = cut_lineage(rows.join(first, "doc_id").where("id <> first OR c > 1")
                        .select(F.col("doc_id").alias("_g"), F.col("id").alias("doc_id"), (F.col("id") == F.col("first")).alias("own")))
    at = ["_g", "doc_id"]
    one = s.join(_small(spare.drop("own")), at, "left_anti").select("_g", "shingles")
    twice = (spare.where("own").drop("own"))
    if twice.limit(1).count():
        one = one.unionByName(s.join(_small(twice), at, "left_semi").select("_g", "shingles").dropDuplicates(["_g"]))
    return one.select(F.col("_g").alias("doc_id"), "shingles"), rows


def counted_pairs(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``doc_a, doc_b, jaccard`` of distinct contents -> with ``n``, the pairs of rows of different
    documents that each stands for, and the pairs inside each content (``doc_a = doc_b``).

    Pairs of copies are counted, never listed.  A document with several contents is no pair with itself.
    """
    rows = materialize(rows)
    size = rows.groupBy("doc_id").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("own"))
    side = lambda x: size.select(F.col("doc_id").alias(f"doc_{x}"), F.col("n").alias(f"n{x}"))
    many = rows.join(rows.groupBy("id").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("id"), "id", "left_semi")
    one, two = (many.select("id", F.col("doc_id").alias(f"doc_{x}"), F.col("c").alias(f"c{x}")) for x in "ab")
    both = one.join(two, "id").where("doc_a < doc_b").groupBy("doc_a", "doc_b").agg(F.sum(F.col("ca") * F.col("cb")).alias("own"))
    across = pairs.join(side("a"), "doc_a").join(side("b"), "doc_b").join(both, ["doc_a", "doc_b"], "left").select(
        "doc_a", "doc_b", "jaccard", (F.col("na") * F.col("nb") - F.coalesce("own", F.lit(0))).alias("n"))
    inside = size.select(F.col("doc_id").alias("doc_a"), F.col("doc_id").alias("doc_b"), F.lit(1.0).alias("jaccard"),
                         F.expr("(n * n - own) div 2").alias("n"))
    return across.unionByName(inside).where("n > 0")


def exact_similar_pairs(docs: DataFrame, k: int = 3, threshold: float = DEFAULT_THRESHOLD,
                        block: int = DEFAULT_BLOCK) -> DataFrame:
    sets = materialize_sets(shingle(docs, k, with_key=True))
    pairs = exact_similar_pairs_from_sets(sets, threshold, block)
    sets.unpersist()  # the representatives are kept
    return pairs


# --------------------------------------------------------------------- C6 / D4
def pair_sets(reported: DataFrame, truth: DataFrame) -> DataFrame:
    """Full outer join of distinct pairs -> ``doc_a, doc_b, in_reported, in_truth``."""
    r = reported.select("doc_a", "doc_b").distinct().withColumn("_r", F.lit(True))
    t = truth.select("doc_a", "doc_b").distinct().withColumn("_t", F.lit(True))
    return (r.join(t, ["doc_a", "doc_b"], "full_outer")
            .select("doc_a", "doc_b",
                    F.coalesce("_r", F.lit(False)).alias("in_reported"),
                    F.coalesce("_t", F.lit(False)).alias("in_truth")))


def pair_f1(reported: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 (0 where undefined)."""
    s = pair_sets(reported, truth)
    agg = s.agg(
        F.sum(F.when(F.col("in_reported") & F.col("in_truth"), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(F.col("in_reported") & ~F.col("in_truth"), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~F.col("in_reported") & F.col("in_truth"), 1).otherwise(0)).cast("bigint").alias("fn"))
    tp, fp, fn = F.coalesce("tp", F.lit(0)), F.coalesce("fp", F.lit(0)), F.coalesce("fn", F.lit(0))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return agg.select(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


# --------------------------------------------------------------------- L3
def connected_groups(edges: DataFrame) -> DataFrame:
    """Connected components of ``doc_a, doc_b``: ``doc_id, group_id`` (the
    smallest id of the component), computed to convergence."""
    return (connected_components(edges, "doc_a", "doc_b")
            .select(F.col("node").alias("doc_id"), F.col("component").alias("group_id")))


def dedup_keep_first(docs: DataFrame, k: int = 3, threshold: float = DEFAULT_THRESHOLD,
                     r: int = DEFAULT_R, b: int = DEFAULT_B, seed: int = DEFAULT_SEED) -> DataFrame:
    """Every document with its near-duplicate group (its own id if it has none);
    the lowest id of each group is kept: ``doc_id, group_id, keep``."""
    edges = near_dup_pairs(docs, k, r, b, threshold, seed)
    g = docs.select("doc_id").distinct().join(connected_groups(edges), "doc_id", "left")
    return (g.withColumn("group_id", F.coalesce("group_id", "doc_id"))
            .withColumn("keep", F.col("doc_id") == F.col("group_id")))


# --------------------------------------------------------------------- cross-set
def containment_pairs(items: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """``item_id, doc_id, containment``: share of an item's shingles that a document has,
    at or above the threshold (both ``doc_id, shingles``).  The shingles of the items
    meet those of the documents by an equi-join; counting combines map-side."""
    one = items.select(F.col("doc_id").alias("item_id"), F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    two = docs.select("doc_id", F.explode("shingles").alias("s"))
    c = one.join(two, "s").groupBy("item_id", "doc_id", "n").agg(F.count(F.lit(1)).alias("c"))
    return c.select("item_id", "doc_id", (F.col("c") / F.col("n")).alias("containment")).where(F.col("containment") >= threshold)


def cross_near_dup_pairs(left_sets: DataFrame, right_sets: DataFrame, r: int = DEFAULT_R,
                         b: int = DEFAULT_B, threshold: float = DEFAULT_THRESHOLD,
                         seed: int = DEFAULT_SEED, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Pairs (left_id, right_id) across two set tables with Jaccard >= t.

    Both sides use the same MinHash/band family; candidates come from a
    skew-tiled bucket join, then exact verification.
    """
    ls = left_sets.where(F.size("shingles") > 0)
    rs = right_sets.where(F.size("shingles") > 0)
    lb = bands(minhash(ls, r * b, seed), r, b, seed).withColumnRenamed("doc_id", "left_id")
    rb = bands(minhash(rs, r * b, seed), r, b, seed).withColumnRenamed("doc_id", "right_id")
    cands = bucket_cross_pairs(lb, rb, ["band", "key"], "left_id", "right_id", block).distinct()
    la = ls.select(F.col("doc_id").alias("left_id"), F.col("shingles").alias("_sa"))
    ra = rs.select(F.col("doc_id").alias("right_id"), F.col("shingles").alias("_sb"))
    out = (cands.join(la, "left_id").join(ra, "right_id")
           .select("left_id", "right_id", jaccard(F.col("_sa"), F.col("_sb")).alias("jaccard")))
    return threshold_filter(out, threshold)
