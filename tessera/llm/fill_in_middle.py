"""Fill-in-the-middle transformation by piece tables.

A document becomes a table of descriptors ``(buffer, start, stop)`` over two
immutable buffers: the text's bytes and the sentinels.  Cutting splits
descriptors, an arrangement permutes them and puts sentinels between them, the
inverse permutation restores the text, and hashes and outputs stream over the
descriptors; no part of a text is copied before it is written out.

Cuts lie between units (``[A-Za-z]+`` or one other code point), at places drawn
from SHA-256 of the document's id, so a retried task cuts alike.

Defined cases: a null text counts as empty; an empty text, or one that holds a
sentinel, stays plain; a null id is drawn as an empty number; repeated rows give
repeated rows; a very long text is scanned in blocks; an empty table gives an
empty table; only the id and text columns are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_rows, steps

#: The sentinels before prefix, suffix and middle.
SENTINELS = b"<P>", b"<S>", b"<M>"
#: Order of the parts (0 prefix, 1 middle, 2 suffix) in each form's output.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: The sentinel before each part.
MARK_OF = (0, 2, 1)
TEXT, MARKS = 0, 1
#: Bytes that one step of a scan looks at.
BLOCK = 1 << 20

ARRANGED = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, "
            "output_sha256 string, pieces array<struct<buffer:int,start:bigint,stop:bigint>>")


class PieceTable:
    """Descriptors over immutable buffers."""

    def __init__(self, buffers: Sequence[bytes], pieces: Sequence[tuple[int, int, int]]):
        self.buffers = [memoryview(b) for b in buffers]
        self.pieces = list(pieces)

    def cut(self, places: Sequence[int]) -> PieceTable:
        """The same bytes with descriptors split at ascending offsets of the whole;
        a place on a border, or named twice, makes an empty descriptor."""
        out, at, todo = [], 0, list(places)
        for b, lo, hi in self.pieces:
            while todo and todo[0] <= at + hi - lo:
                mid = lo + todo.pop(0) - at
                out.append((b, lo, mid))
                at, lo = at + mid - lo, mid
            out.append((b, lo, hi))
            at += hi - lo
        return PieceTable(self.buffers, out)

    def take(self, order: Sequence[int]) -> PieceTable:
        """The descriptors in another order (a permutation or a choice)."""
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def between(self, buffer: int, spans: Sequence[tuple[int, int]]) -> PieceTable:
        """Span k of another buffer put before descriptor k."""
        return PieceTable(self.buffers, [p for (lo, hi), piece in zip(spans, self.pieces, strict=True) for p in ((buffer, lo, hi), piece)])

    def stream(self) -> Iterator[memoryview]:
        for b, lo, hi in self.pieces:
            yield self.buffers[b][lo:hi]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for part in self.stream():
            h.update(part)
        return h.hexdigest()

    def tobytes(self) -> bytes:
        return b"".join(self.stream())


def inverse(order: Sequence[int]) -> list[int]:
    out = [0] * len(order)
    for k, x in enumerate(order):
        out[x] = k
    return out


MARK_SPANS = [(3 * k, 3 * k + 3) for k in range(3)]


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[4 * k:4 * k + 4], "big") for k in range(4)]


def _code_points(b: np.ndarray) -> int:
    return sum(int(np.count_nonzero((b[i:i + BLOCK] & 0xC0) != 0x80)) for i in range(0, len(b), BLOCK))


def _unit_starts(b: np.ndarray, lo: int) -> np.ndarray:
    """Which bytes of the block at ``lo`` begin a unit."""
    part = b[lo:lo + BLOCK]
    letter = ((part | 0x20) - np.uint8(97)) < 26
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[:1] = lo > 0 and int(b[lo - 1] | 0x20) - 97 in range(26)
    return ((part & 0xC0) != 0x80) & ~(letter & before)


def unit_places(b: np.ndarray, places: Sequence[int], counts: list[int]) -> list[int]:
    """Byte offset at which each (ascending) number of units ends; ``counts``: units of each block."""
    out = []
    for k in places:
        block = 0
        while block < len(counts) and k >= counts[block]:
            k -= counts[block]
            block += 1
        if block == len(counts):
            out.append(len(b))
        else:
            out.append(block * BLOCK + int(np.flatnonzero(_unit_starts(b, block * BLOCK))[k]))
    return out


def cut_row(doc_id: int | None, raw: bytes, b: np.ndarray, seed: int, plain_from: int, spm_below: int):
    """(number of units, form, piece table of the output, code points of prefix and middle)."""
    counts = [int(np.count_nonzero(_unit_starts(b, i))) for i in range(0, len(b), BLOCK)]
    n = sum(counts)
    h = draws(doc_id, seed)
    whole = PieceTable((raw, b"".join(SENTINELS)), [(TEXT, 0, len(raw))])
    if not raw or any(s in raw for s in SENTINELS) or h[2] % 100 >= plain_from:
        return n, "plain", whole, None, None
    form = "spm" if h[3] % 100 < spm_below else "psm"
    p, q = unit_places(b, sorted((h[0] % (n + 1), h[1] % (n + 1))), counts)
    order = ORDERS[form]
    out = whole.cut((p, q)).take(order).between(MARKS, [MARK_SPANS[MARK_OF[k]] for k in order])
    return n, form, out, _code_points(b[:p]), _code_points(b[p:q])


def restored(raw: bytes, form: str) -> PieceTable:
    """The text as descriptors over an output: cut at the sentinels, which the text
    cannot hold, take the parts and undo the permutation.  An output without the
    sentinels of its form comes back as it is."""
    whole = PieceTable((raw,), [(0, 0, len(raw))])
    if form not in ORDERS:
        return whole
    places, at = [], 0
    for k in ORDERS[form]:
        at = raw.find(SENTINELS[MARK_OF[k]], at)
        if at < 0:
            return whole
        places += [at, at + len(SENTINELS[MARK_OF[k]])]
        at = places[-1]
    parts = whole.cut(places).take((2, 4, 6))
    return parts.take(inverse(ORDERS[form]))


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def arrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
            plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, pieces``.

    Of a hundred texts about ``plain_from`` are cut, and of those ``spm_below`` in a
    hundred put the suffix first.  ``pieces`` are the output's descriptors over the
    text (buffer 0) and the sentinels (buffer 1).
    """
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, off = byte_rows(batch.column(1))
            for i, j in steps(off):
                rows = []
                for k in range(i, j):
                    b = raw[off[k]:off[k + 1]]
                    rows.append(cut_row(ids[k], b.tobytes(), b, seed, plain_from, spm_below))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[i:j], pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4] for r in rows], pa.int64()),
                    _strings([r[2].tobytes() for r in rows]),
                    pa.array([r[2].sha256() for r in rows], pa.string()),
                    pa.array([[dict(zip(("buffer", "start", "stop"), p)) for p in r[2].pieces] for r in rows],
                             pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))),
                ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"])
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ARRANGED)


def restore(arranged: DataFrame, keep_cols: Sequence[str] = ()) -> DataFrame:
    """``keep_cols`` and ``restored_text, restored_sha256`` of rows with ``output`` and ``form``."""
    schema = ", ".join([*(f"{c} {arranged.schema[c].dataType.simpleString()}" for c in keep_cols), "restored_text string", "restored_sha256 string"])

    def run(batches):
        for batch in batches:
            forms = batch.column(1).to_pylist()
            raw, off = byte_rows(batch.column(0))
            for i, j in steps(off):
                texts = [restored(raw[off[k]:off[k + 1]].tobytes(), forms[k]) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2 + c).slice(i, j - i) for c in range(len(keep_cols))]
                    + [_strings([t.tobytes() for t in texts]), pa.array([t.sha256() for t in texts], pa.string())],
                    names=[*keep_cols, "restored_text", "restored_sha256"])
    return arranged.select("output", "form", *keep_cols).mapInArrow(run, schema)
