"""Exact removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut every text into phrases: of the 16-byte strings inside
a window of ``MATCH`` bytes, the leftmost one with the smallest hash is that
window's trigger, and a phrase is the stretch of windows with one trigger.  As
neighbouring phrases overlap by MATCH - 1 bytes, every string of MATCH bytes
lies whole in one phrase, and equal strings always lie in phrases of equal
trigger.  The parse says where which phrase occurs; the dictionary holds each
distinct phrase once, with the smallest doc_id that has it.

1. Trigger hashes are dealt to groups by hash; only phrases whose trigger occurs
   in several documents go on (the others cannot hold a repeated string).
2. The phrases of those triggers are dealt by trigger.  In each group the
   suffixes (of at least MATCH bytes) of the dictionary are sorted; this suffix
   array, read with the parse, is the corpus order of all suffixes, and a run
   with a common prefix of MATCH bytes is one repeated string.  A string is
   removed in every document but the smallest of its run.
3. The spans go back to their texts.

All tables travel as packed arrays, one for each task and group.  Each task
sends a trigger or a phrase once, however many of its documents hold it, and
settles the others itself, so a string that a third of the documents hold costs
a group one entry for each task.  Groups are as many as the bytes ask for.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_rows, one_text_per_id, steps
from tessera.llm.hashing_features import MIX, mix
from tessera.sources.parallel import spread

MATCH = 50
GRAM = 16
#: bytes of text for each group
GROUP_BYTES = 8 << 20
LEAST_GROUPS = 64
STEP = 1 << 19
#: texts of a batch, suffixes and places that a task handles at once
BATCH_BYTES, WINDOWS, PLACES = 12 << 20, 200_000, 20_000
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POS = (1 << 24) - 1


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(data) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _small(x: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest type that holds them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _deltas(x: np.ndarray) -> np.ndarray:
    return _small(np.diff(x, prepend=x.dtype.type(0))) if len(x) else x


def _sums(x: np.ndarray, kind) -> np.ndarray:
    return np.cumsum(x.astype(kind), dtype=kind)


# ------------------------------------------------------------------ the parse
def _grams(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    h, n, base = _TABLE[b], 1, 0x9E3779B97F4A7C15
    while n < GRAM:
        h = h[:-n] * np.uint64(pow(base, n, 1 << 64)) + h[n:]
        n *= 2
    return mix(h)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w neighbours."""
    n = 1
    while n * 2 <= w:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[:len(x) - (w - n)], x[w - n:]) if n < w else x


def parse(raw: np.ndarray, off: np.ndarray, match: int = MATCH):
    """Phrases of the texts in a buffer: arrays (row, 48-bit trigger hash, first
    window, last window, trigger place), places counted in the buffer."""
    out = []
    for s in range(0, max(0, len(raw) - match + 1), STEP):
        b = raw[s:s + STEP + match - 1]
        if len(b) < match:
            break
        g = _grams(b)
        mark = (g & ~np.uint64(_POS)) | np.arange(len(g), dtype=np.uint64)
        at = (_least(mark, match - GRAM + 1) & np.uint64(_POS)).astype(np.int64)
        start = s + np.arange(len(at))
        row = np.searchsorted(off, start, side="right") - 1
        inside = start + match <= off[row + 1]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        a, z = np.flatnonzero(first), np.flatnonzero(last)
        # hashed anew: triggers are small hashes, groups want even ones
        out.append((row[a], mix(g[at[a]] + MIX) >> np.uint64(16), s + a, s + z, s + at[a]))
    if not out:
        e = np.zeros(0, np.int64)
        return e, e.astype(np.uint64), e, e, e
    return tuple(np.concatenate(x) for x in zip(*out))


def _code(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """64-bit name of a (document, trigger) pair; a false match only costs work."""
    return mix(doc.astype(np.uint64) * MIX + h)


def _group_of_doc(doc: np.ndarray, groups: int) -> np.ndarray:
    return (mix(doc.astype(np.uint64) + MIX) % np.uint64(groups)).astype(np.int64)


def _group_of_trigger(h: np.ndarray, groups: int) -> np.ndarray:
    """Groups are ranges of the hash, so sorted hashes are sorted groups."""
    return ((h >> np.uint64(16)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _rows(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    k, v = zip(*parts) if parts else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(v, pa.binary())], names=["slot", "data"])


SENT = "slot bigint, data binary"


def _slices(group: np.ndarray):
    """(group, start, end) of the runs of a sorted array."""
    if len(group):
        cut = np.flatnonzero(np.diff(group)) + 1
        for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(group)]):
            yield int(group[s]), s, e


def _codes_out(doc: np.ndarray, h: np.ndarray, groups: int, base: int) -> list:
    """(document, trigger) pairs for the groups of their documents."""
    g = _group_of_doc(doc, groups)
    order = np.argsort(g, kind="stable")
    code = _code(doc, h)[order]
    return [(base + k, pack(np.sort(code[s:e]))) for k, s, e in _slices(g[order])]


def by_group(docs: DataFrame, groups: int) -> DataFrame:
    """``slot, doc_id, text``: texts with the group in which packed arrays for them arrive."""
    def run(batches):
        for b in batches:
            g = _group_of_doc(np.asarray(b.column(0)), groups)
            yield pa.RecordBatch.from_arrays([pa.array(g), *b.columns], names=["slot", "doc_id", "text"])
    return docs.mapInArrow(run, "slot bigint, doc_id bigint, text string")


# ------------------------------------------------------------------ 1. triggers
def _triggers(groups: int, match: int):
    """Tasks over scanned texts: one entry for each trigger and batch, for the group
    of the trigger; to the other documents of the batch that hold it, at once."""
    def run(batches):
        for b in batches:
            docs = np.asarray(b.column(0))
            every, ends = byte_rows(b.column(1))
            for i, j in steps(ends, BATCH_BYTES):
                yield from one(docs[i:j], every[ends[i]:ends[j]], ends[i:j + 1] - ends[i])

    def one(doc, raw, off):
        row, h, *_ = parse(raw, off, match)
        d = doc[row]
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[new], d[new]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        shared = np.zeros(len(h), bool)
        shared[:-1] = head[:-1] & ~head[1:]
        parts = _codes_out(d[~head], h[~head], groups, groups)
        hh, dd, ss = h[head], d[head], shared[head]
        for k, s, e in _slices(_group_of_trigger(hh, groups)):
            ids, which = np.unique(dd[s:e], return_inverse=True)
            parts.append((k, pack(hh[s:s + 1], _deltas(hh[s:e] - hh[s]), ids[:1], _deltas(ids - ids[0]), _small(which), np.packbits(ss[s:e]))))
        for s in range(0, len(parts), 4096):
            yield _rows(parts[s:s + 4096])
    return run


def _repeated(groups: int):
    """Group of a trigger range: which (document, trigger) pairs are not alone."""
    def run(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        if slot >= groups:
            return pa.table({"slot": pa.array([slot - groups] * table.num_rows, pa.int64()), "data": table.column("data")})
        hs, ds, ms = [], [], []
        for x in table.column("data"):
            h0, dh, i0, di, which, bits = unpack(x.as_py())
            hs.append(h0 + _sums(dh, np.uint64))
            ds.append((i0 + _sums(di, np.int64))[which])
            ms.append(np.unpackbits(bits)[:len(which)].astype(bool))
        h, d, m = np.concatenate(hs), np.concatenate(ds), np.concatenate(ms)
        order = np.argsort(h, kind="stable")
        h, d, m = h[order], d[order], m[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(h)))
        more = (size > 1) | np.logical_or.reduceat(m, at)
        keep = np.repeat(more, size)
        return pa.Table.from_batches([_rows(_codes_out(d[keep], h[keep], groups, 0))])
    return run


# ------------------------------------------------------------------ 2. phrases
def _phrase_bytes(raw, start, size):
    """The bytes raw[start:start + size] of all phrases, concatenated."""
    out = []
    for c in range(0, len(size), PLACES):
        f, n = start[c:c + PLACES], size[c:c + PLACES]
        out.append(raw[np.arange(n.sum()) + np.repeat(f - (np.cumsum(n) - n), n)])
    return np.concatenate(out) if out else raw[:0]


def _spans_out(doc, first, last, groups: int, base: int) -> list:
    """Removed windows for the groups of their documents."""
    g = _group_of_doc(doc, groups)
    order = np.lexsort((first, doc, g))
    g, doc, first, last = g[order], doc[order], first[order], last[order]
    out = []
    for k, s, e in _slices(g):
        ids, which = np.unique(doc[s:e], return_inverse=True)
        out.append((base + k, pack(ids, _small(which), _small(first[s:e]), _small(last[s:e] - first[s:e]))))
    return out


def _phrases(groups: int, match: int):
    """Texts and repeated triggers of a group of documents -> its dictionary and parse."""
    def run(texts: pa.Table, codes: pa.Table) -> pa.Table:
        if not codes.num_rows or not texts.num_rows:
            return pa.Table.from_batches([_rows([])])
        code = np.unique(np.concatenate([unpack(x.as_py())[0] for x in codes.column("data")]))
        doc = np.asarray(texts.column("doc_id").combine_chunks())
        raw, off = byte_rows(texts.column("text"))
        row, h, first, last, at = parse(raw, off, match)
        hit = np.isin(_code(doc[row], h), code)
        row, h, first, last, at = row[hit], h[hit], first[hit], last[hit], at[hit]
        size, d = last - first + match, doc[row]
        # equal phrases of this group of documents: by two 64-bit hashes, then one entry for the smallest id
        body = _phrase_bytes(raw, first, size)
        begin = np.cumsum(size) - size
        if not len(h):
            return pa.Table.from_batches([_rows([])])
        name = _names(body, begin, size) + mix((at - first).astype(np.uint64))
        order = np.lexsort((d, name, h))
        head = np.ones(len(order), bool)
        n, hh, dd = name[order], h[order], d[order]
        head[1:] = (n[1:] != n[:-1]) | (hh[1:] != hh[:-1])
        which = np.cumsum(head) - 1
        small = dd[head][which]
        later = dd > small
        pos = first - off[row]
        o = order[later]
        parts = _spans_out(d[o], pos[o], pos[o] + (last - first)[o], groups, groups)
        # the parse keeps every place where the smallest document has the phrase
        o, w = order[~later], which[~later]
        lead = order[head]
        hl = h[lead]
        place = np.searchsorted(w, np.arange(len(lead) + 1))
        for k, s, e in _slices(_group_of_trigger(hl, groups)):
            i = lead[s:e]
            p0, p1 = place[s], place[e]
            ids, ref = np.unique(d[i], return_inverse=True)
            text = _phrase_bytes(raw, first[i], size[i])
            parts.append((k, pack(hl[s:s + 1], _deltas(hl[s:e] - hl[s]), _small(size[i]), _small(at[i] - first[i]), ids, _small(ref), text,
                                  _small(w[p0:p1] - s), _small(pos[o[p0:p1]]))))
        return pa.Table.from_batches([_rows(parts)])
    return run


def _names(body: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each phrase (phrases are shorter than 2 * MATCH bytes)."""
    out = np.empty(len(size), np.uint64)
    power = np.cumprod(np.full(int(size.max()) if len(size) else 1, 0x9FB21C651E98DF25, np.uint64))
    for c in range(0, len(size), PLACES):
        n = size[c:c + PLACES]
        first = np.cumsum(n) - n
        pos = np.arange(n.sum()) - np.repeat(first, n)
        b = body[begin[c]:begin[c] + len(pos)]
        out[c:c + PLACES] = mix(np.add.reduceat(_TABLE[b] * power[pos], first))
    return out


def _portions(h: np.ndarray, n: np.ndarray):
    """Ranges of dictionary entries (sorted by trigger) of about WINDOWS suffixes each;
    a trigger's entries stay together."""
    runs = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    part = (np.cumsum(n) - n)[runs] // WINDOWS
    first = runs[np.flatnonzero(np.append(True, part[1:] != part[:-1]))].tolist()
    return zip(first, [*first[1:], len(h)])


def _suffix_minima(text: np.ndarray, at: np.ndarray, n: np.ndarray, low: np.ndarray, match: int) -> np.ndarray:
    """Sorts the suffixes of some entries by their first ``match`` bytes (a suffix
    array as deep as it matters) and gives each suffix the smallest document of its run."""
    of = np.repeat(np.arange(len(n)), n)
    starts = at[of] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.lib.stride_tricks.sliding_window_view(text, match)[starts].view(f"S{match}").ravel()
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    head = np.ones(len(sa), bool)
    head[1:] = key[1:].view(f"V{match}") != key[:-1].view(f"V{match}")
    heads = np.flatnonzero(head)
    least = np.empty(len(sa), np.int64)
    least[sa] = np.repeat(np.minimum.reduceat(low[of[sa]], heads), np.diff(np.append(heads, len(sa))))
    return least


def _matched(groups: int, match: int):
    """Group of a trigger range: sorts the dictionary's suffixes, reads the runs with
    the parse, and returns the windows to remove."""
    def run(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        if slot >= groups:
            return pa.table({"slot": pa.array([slot - groups] * table.num_rows, pa.int64()), "data": table.column("data")})
        cols = [[] for _ in range(6)]
        base = 0
        for x in table.column("data"):
            h0, dh, size, lead, ids, ref, text, which, pos = unpack(x.as_py())
            h = h0 + _sums(dh, np.uint64)
            for c, v in zip(cols, (size.astype(np.int64), ids[ref], text, which.astype(np.int64) + base, pos.astype(np.int64), h)):
                c.append(v)
            base += len(h)
        size, doc, text, which, pos, h = (np.concatenate(c) for c in cols)
        begin = np.cumsum(size) - size
        # one dictionary entry for equal phrases: only the smallest document's goes on
        name = _names(text, begin, size)
        order = np.lexsort((doc, name, h))
        head = np.ones(len(order), bool)
        head[1:] = (name[order][1:] != name[order][:-1]) | (h[order][1:] != h[order][:-1])
        entry = np.cumsum(head) - 1
        own = np.empty(len(order), np.int64)
        own[order] = entry  # dictionary entry of each sent phrase
        low = doc[order][head]
        dict_at, dict_size = begin[order][head], size[order][head]
        n = dict_size - match + 1
        at = np.cumsum(n) - n
        least = np.empty(int(n.sum()), np.int64)
        for e0, e1 in _portions(h[order][head], n):
            least[at[e0]:at[e1 - 1] + n[e1 - 1]] = _suffix_minima(text, dict_at[e0:e1], n[e0:e1], low[e0:e1], match)
        # the parse: each place of each sent phrase, against the smallest document of its suffixes
        out = []
        for c in range(0, len(which), PLACES):
            d, k, p = doc[which[c:c + PLACES]], own[which[c:c + PLACES]], pos[c:c + PLACES]
            many = n[k]
            occ = np.repeat(np.arange(len(k)), many)
            w = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            gone = least[at[k[occ]] + w] < d[occ]
            begins = gone.copy()
            begins[1:] &= ~gone[:-1] | (occ[1:] != occ[:-1])
            ends = gone.copy()
            ends[:-1] &= ~gone[1:] | (occ[1:] != occ[:-1])
            a, z = np.flatnonzero(begins), np.flatnonzero(ends)
            out.append((d[occ[a]], p[occ[a]] + w[a], p[occ[a]] + w[z]))
        return pa.Table.from_batches([_rows(_spans_out(*(np.concatenate(x) for x in zip(*out)), groups, 0) if out else [])])
    return run


# ------------------------------------------------------------------ 3. removal
def _removed(match: int):
    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        ids, first, last = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x in spans.column("data"):
            u, which, f, n = unpack(x.as_py())
            ids.append(u[which])
            first.append(f.astype(np.int64))
            last.append(f.astype(np.int64) + n.astype(np.int64) + match)
        ids, first, last = np.concatenate(ids), np.concatenate(first), np.concatenate(last)
        order = np.lexsort((first, ids))
        ids, first, last = ids[order], first[order], last[order]
        doc = np.asarray(texts.column("doc_id").combine_chunks(), np.int64)
        raw, off = byte_rows(texts.column("text"))
        lo, hi = np.searchsorted(ids, doc), np.searchsorted(ids, doc, side="right")
        cuts, kept = [], []
        for r in range(len(doc)):
            b = raw[off[r]:off[r + 1]]
            s, e = first[lo[r]:hi[r]], last[lo[r]:hi[r]]
            if not len(s):
                cuts.append([])
                kept.append(b.tobytes())
                continue
            reach = np.maximum.accumulate(e)
            new = np.ones(len(s), bool)
            new[1:] = s[1:] > reach[:-1]
            at = np.flatnonzero(new)
            a, z = s[at], reach[np.append(at[1:] - 1, len(s) - 1)]
            cuts.append([{"start": int(i), "end": int(j)} for i, j in zip(a, z)])
            kept.append(b"".join(b[i:j].tobytes() for i, j in zip([0, *z], [*a, len(b)])))
        return pa.table({"doc_id": texts.column("doc_id"), "n_bytes": pa.array(np.diff(off)),
                         "spans": pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())})
    return run


RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


def remove_repeats(docs: DataFrame, match: int = MATCH, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: the maximal removed byte runs
    and the bytes that stay.

    Null texts count as empty.  Rows with a null id have no place in the order:
    they lose nothing and remove nothing.  Repeated rows of an id are one
    document; of different texts under one id the one with the smallest hash is
    the document, and the others lose and remove nothing.  An empty table gives
    an empty result.
    """
    if match < 2 * GRAM:
        raise ValueError(f"match must be at least {2 * GRAM}")
    named, aside = one_text_per_id(docs, id_col, text_col)
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(LEAST_GROUPS, -(-size // group_bytes))
    codes = (spread(named).mapInArrow(_triggers(groups, match), SENT)
             .groupBy("slot").applyInArrow(_repeated(groups), SENT))
    texts = by_group(named, groups)
    phrases = texts.groupBy("slot").cogroup(codes.groupBy("slot")).applyInArrow(_phrases(groups, match), SENT)
    spans = phrases.groupBy("slot").applyInArrow(_matched(groups, match), SENT)
    done = texts.groupBy("slot").cogroup(spans.groupBy("slot")).applyInArrow(_removed(match), RESULT)
    none = aside.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                        F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)").alias("spans"), F.encode("text", "UTF-8").alias("kept"))
    return done.unionByName(none)
