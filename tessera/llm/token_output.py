"""Training-order materialisation of token ids.

Texts are tokenised where they are scanned and packed into sequences of
``length`` ids (each text ends with the tokeniser's end id; the last sequence of
a scan partition is filled with that id).  Scan partitions are cut by the bytes of
the input's files alone (``scan_by_bytes``), so however many cores read a table, the
same files give the same sequences.  A sequence's ordinal is its place in the scan
order.  A keyed Feistel network over the next even number of bits,
with cycle-walking back into 0..n-1, permutes the n ordinals to global slots:
any slot can be computed, and inverted, from the key alone.  The sequences are
range-partitioned by slot into at most ``WRITERS`` ranges of whole shards, and each
task writes its shards one after another in fixed-stride records: slot k is record k % per_shard of shard k // per_shard, so training
reads sequentially and resumes at any slot.  A shard appears under its name
only when it is whole; a second attempt writes the same bytes.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keep
from tessera.llm.tokens import Encoder
from tessera.session import checkpoint_dir

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 2048
SHARD_RECORDS = 4096
KEY = 0x5DEECE66D
ROUNDS = 6

#: Bytes of files in a scan partition, unless that made more than SCANS of them.
SCAN_BYTES = 16 << 20
SCANS = 50_000
#: Tasks that write shards, at most.
WRITERS = 8_192

_encoders: dict[int, Encoder] = {}


def _encoder(ranks: bytes) -> Encoder:
    k = zlib.crc32(ranks)
    if k not in _encoders:
        _encoders[k] = Encoder(ranks)
    return _encoders[k]


# ------------------------------------------------------------------ permutation
def _round(x: np.ndarray, key: int, r: int) -> np.ndarray:
    h = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0xD1342543DE82EF95 + r * 0xA24BAED4963EE407) & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _once(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> bits, x & mask
    for r in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        if back:
            left, right = right ^ (_round(left, key, r) & mask), left
        else:
            left, right = right, left ^ (_round(right, key, r) & mask)
    return left << bits | right


def permute(x, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """Slots of ordinals 0..n-1, or with ``back`` the ordinals of slots."""
    x = np.asarray(x, np.uint64)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    out = _once(x, half, key, back)
    while (far := out >= n).any():  # walk the cycle until it is back inside
        out[far] = _once(out[far], half, key, back)
    return out.astype(np.int64)


# ------------------------------------------------------------------ sequences
class _Packer:
    """Cuts a stream of documents into sequences; remembers which ids they hold."""

    def __init__(self, enc: Encoder, length: int):
        self.enc, self.length = enc, length
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.size = 0

    def add(self, doc_id, ids: np.ndarray):
        """Yields whole sequences: (ids, doc_ids, count of own ids)."""
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.length - self.size)
            self.parts.append(ids[at:at + take])
            self.docs.append(doc_id)
            self.size += take
            at += take
            if self.size == self.length:
                yield self.flush()

    def flush(self):
        n = self.size
        fill = np.full(self.length - n, self.enc.end, self.enc.dtype)
        out = (np.concatenate([*self.parts, fill]).tobytes(), self.docs, n)
        self.parts, self.docs, self.size = [], [], 0
        return out


@contextmanager
def scan_by_bytes(df: DataFrame) -> Iterator[None]:
    """Plans made here cut files into partitions by bytes, whatever the number of cores;
    the settings come back afterwards.  (A table that is no scan keeps its partitions.)"""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    want = {"spark.sql.files.maxPartitionBytes": str(max(SCAN_BYTES, -(-size // SCANS))), "spark.sql.files.openCostInBytes": str(1 << 20),
            "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionNum": None}
    old = {k: spark.conf.get(k, None) for k in want}
    put = lambda k, v: spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        for k, v in want.items():
            put(k, v)
        yield
    finally:
        for k, v in old.items():
            put(k, v)


def sequences(docs: DataFrame, ranks: bytes, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_ids, n_tokens, record``: packed sequences in scan order."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    share = d.sparkSession.sparkContext.broadcast(ranks)  # one tokeniser file

    def run(batches):
        enc = _encoder(share.value)
        pack = _Packer(enc, length)

        def batch(rows):
            r, i, n = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(i, pa.list_(pa.int64())), pa.array(n, pa.int32()), pa.array(r, pa.binary())], names=["doc_ids", "n_tokens", "record"])

        rows = []
        for b in batches:
            for k, t in zip(b.column(0), b.column(1)):
                rows += pack.add(k.as_py(), enc.encode(t.as_py()))
                if len(rows) >= 512:
                    yield batch(rows)
                    rows = []
        if pack.size:
            rows.append(pack.flush())
        if rows:
            yield batch(rows)

    return d.mapInArrow(run, "doc_ids array<bigint>, n_tokens int, record binary")


def _files(base: str):
    uri = base if "://" in base or base.startswith("/") or base.startswith("file:") else f"/{base}"
    return pafs.FileSystem.from_uri(uri)


def materialize_tokens(docs: DataFrame, out: str, ranks_path: str = RANKS, length: int = LENGTH, per_shard: int = SHARD_RECORDS,
                       key: int = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards under ``out`` when the result is computed and returns the
    index: ``slot, shard, byte_offset, n_tokens, doc_ids, crc32`` of each record.

    ``out`` must be a store that Arrow opens (file, hdfs, s3, gs) and that
    executors and driver share.  A null or empty text is one end id; a null id
    stands in doc_ids as null; repeated rows are written as often as they occur.
    An empty table writes only the manifest.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    enc = Encoder(ranks)
    stride = length * enc.dtype.itemsize
    with scan_by_bytes(docs):
        seqs = keep(sequences(docs, ranks, length, id_col, text_col)).withColumn("_at", F.monotonically_increasing_id())
        # one row for each scan partition, at most about SCANS
        per = seqs.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = sum(r.n for r in per)
    count = np.zeros(max((r.p for r in per), default=-1) + 1, np.int64)
    for r in per:
        count[r.p] = r.n
    first = docs.sparkSession.sparkContext.broadcast(np.cumsum(count) - count)  # 8 bytes for each scan partition
    shards = -(-n // per_shard)
    writers = max(1, min(shards, WRITERS))
    where, root = _files(out)
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"sequences": n, "length": length, "dtype": enc.dtype.str, "stride": stride, "per_shard": per_shard,
                            "shards": shards, "key": key, "rounds": ROUNDS, "end": enc.end}).encode())

    def slots(batches):
        for b in batches:
            pos = np.asarray(b.column(3), np.int64)
            ordinal = (pos & (1 << 33) - 1) + first.value[pos >> 33]
            slot = permute(ordinal, n, key)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(slot)], names=["doc_ids", "n_tokens", "record", "slot"])

    def write(batches):
        where, root = _files(out)
        stream = None
        shard, temp = -1, ""

        def close():
            if stream is not None:
                stream.close()
                where.move(temp, f"{root}/shard-{shard:08d}.bin")

        for b in batches:
            slot = np.asarray(b.column(3), np.int64)
            crc = []
            for k, rec in zip((slot // per_shard).tolist(), b.column(2)):
                if k != shard:
                    close()
                    shard, temp = k, f"{root}/_{k:08d}-{uuid.uuid4().hex}"
                    stream = where.open_output_stream(temp)
                buf = rec.as_buffer()
                stream.write(buf)
                crc.append(zlib.crc32(buf))
            yield pa.RecordBatch.from_arrays(
                [b.column(3), pa.array(slot // per_shard), pa.array(slot % per_shard * stride), b.column(1), b.column(0), pa.array(crc, pa.int64())],
                names=["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "crc32"])
        close()

    placed = seqs.mapInArrow(slots, "doc_ids array<bigint>, n_tokens int, record binary, slot bigint")
    shard_of = F.expr(f"slot div {per_shard}")
    dealt = placed.repartitionById(writers, F.floor(shard_of * writers / max(1, shards)).cast("int")).sortWithinPartitions("slot")
    return dealt.mapInArrow(write, "slot bigint, shard bigint, byte_offset bigint, n_tokens int, doc_ids array<bigint>, crc32 bigint")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for shards beside the session's checkpoints, which all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"


def read_slots(out: str, start: int = 0, stop: int | None = None):
    """Records of slots start..stop-1 in order, a shard file at a time."""
    where, root = _files(out)
    with where.open_input_stream(f"{root}/manifest.json") as f:
        m = json.loads(f.read())
    stop = m["sequences"] if stop is None else min(stop, m["sequences"])
    at = start
    while at < stop:
        shard, last = at // m["per_shard"], min(stop, (at // m["per_shard"] + 1) * m["per_shard"])
        with where.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek(at % m["per_shard"] * m["stride"])
            for _ in range(at, last):
                yield np.frombuffer(f.read(m["stride"]), m["dtype"])
        at = last
