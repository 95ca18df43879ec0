import random

import numpy as np
import pytest

from tessera.llm import token_output as T
from tessera.llm.tokens import Encoder


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 256, 1000, 4097, 70001])
def test_permutation_is_one_to_one_and_inverts(n):
    x = np.arange(n)
    y = T.permute(x, n, 99)
    assert sorted(y.tolist()) == x.tolist()
    assert (T.permute(y, n, 99, back=True) == x).all()
    if n > 100:
        assert (y != T.permute(x, n, 100)).any() and abs(np.corrcoef(x, y)[0, 1]) < 0.2


def test_round_trip(docs_of, spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "\n", "gamma 7", "😀"]) for _ in range(rng.choice([0, 1, 30, 900])))) for i in range(150)]
    rows += [(500, None), (None, "no id"), rows[2], (501, "<|endoftext|> is text")]
    out = f"file://{tmp_path}/shards"
    idx = T.materialize_tokens(docs_of(rows), out, length=64, per_shard=50).collect()
    enc = Encoder(open(T.RANKS, "rb").read())
    recs = list(T.read_slots(out))
    assert len(recs) == len(idx) and sorted(r.slot for r in idx) == list(range(len(idx)))
    by = {r.slot: r for r in idx}
    order = T.permute(np.arange(len(recs)), len(recs))
    stream, texts, ids = [], [], []
    for o in order.tolist():  # back in scan order
        r = by[o]
        assert r.shard == o // 50 and r.byte_offset == o % 50 * 128
        stream += recs[o][:r.n_tokens].tolist()
        assert (recs[o][r.n_tokens:] == enc.end).all()
        ids += r.doc_ids
        if r.n_tokens == 0:
            pytest.fail("an empty sequence")
    while enc.end in stream:
        k = stream.index(enc.end)
        texts.append(enc.decode(stream[:k]))
        stream = stream[k + 1:]
    assert not stream
    assert sorted(texts) == sorted(t or "" for _, t in rows)
    assert {i for i in ids} == {i for i, _ in rows}
    part = list(T.read_slots(out, 45, 120))
    assert len(part) == 75 and all((a == b).all() for a, b in zip(part, recs[45:120]))


def test_empty(docs_of, tmp_path):
    out = str(tmp_path / "none")
    assert T.materialize_tokens(docs_of([]), out).count() == 0
    assert list(T.read_slots(out)) == []


SHARDS = """
import hashlib, os, sys
sys.path.insert(0, {root!r})
from tessera.session import get_spark
from tessera.llm import token_output as T
spark = get_spark({master!r})
T.WRITERS, T.SCAN_BYTES = 3, 100_000
idx = T.materialize_tokens(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), {out!r}, length=128, per_shard=40)
rows = sorted(map(str, idx.collect()))
names = sorted(f for f in os.listdir({out!r}) if f.startswith("shard-"))
print("DIGEST", len(rows), len(names), idx.rdd.getNumPartitions(), hashlib.sha256(b"".join(open(os.path.join({out!r}, f), "rb").read() for f in names)).hexdigest(),
      hashlib.sha256("".join(rows).encode()).hexdigest())
"""


def test_shards_do_not_depend_on_the_cores(tmp_path):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(T.__file__))))
    got = []
    for cores in (2, 4):
        code = SHARDS.format(root=root, master=f"local[{cores}]", out=str(tmp_path / f"c{cores}"))
        run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        got.append([x for x in run.stdout.splitlines() if x.startswith("DIGEST")])
    assert got[0] and got[0] == got[1]
    _, rows, shards, writers, *_ = got[0][0].split()
    assert int(shards) > 3 == int(writers) and int(rows) > 40 * 3
