import hashlib
import random
import re

import numpy as np

from tessera.llm import fill_in_middle as M

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def expected(doc_id, text):
    """(n, form, prefix, middle, output) by the plain reading of the rule."""
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_reading(docs_of):
    rng = random.Random(12)
    pieces = ["word", "Ünïcode", "日本語", "\n", " ", "😀", "12", "<", "P>", "S>", "<M", "a", "Z", "é", "\t"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 2, 7, 60, 900])))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "no id at all"), rows[5], rows[5], (5, "another text of one id"), (902, "has <M> inside"),
             (903, "x" * 300), (904, "ends in <"), (905, "<P"), (-7, "negative id")]
    df = M.arrange(docs_of(rows))
    got = df.collect()
    want = [expected(*r) for r in rows]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) \
        == sorted(((d, *w) for (d, _), w in zip(rows, want)), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert all(r.output_sha256 == sha(r.output) for r in got)
    back = M.restore(df, keep_cols=("doc_id", "form"))
    assert back.columns == ["doc_id", "form", "restored_text", "restored_sha256"]
    assert sorted(r.restored_text for r in back.collect()) == sorted(t or "" for _, t in rows)
    assert all(r.restored_sha256 == sha(r.restored_text) for r in back.collect())


def test_pieces_describe_the_output(docs_of):
    rows = [(i, f"Some text number {i}, long enough to be cut. " * 3) for i in range(40)]
    text = dict(rows)
    marks = b"".join(M.SENTINELS)
    for r in M.arrange(docs_of(rows)).collect():
        buffers = (text[r.doc_id].encode(), marks)
        assert b"".join(buffers[p.buffer][p.start:p.stop] for p in r.pieces).decode() == r.output


def test_very_long_text_is_scanned_in_blocks(docs_of, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", "é", " ", "A", "語", "."]) for _ in range(200_000))
    rows = [(i, text[i:]) for i in range(6)]
    got = {r.doc_id: r for r in M.arrange(docs_of(rows)).collect()}
    for d, t in rows:
        assert (got[d].n, got[d].form, got[d].prefix_chars, got[d].middle_chars, got[d].output) == expected(d, t)
    monkeypatch.setattr(M, "BLOCK", 7)           # a word over several blocks is one unit
    for d, t in [(1, "abcdefghijklmnopqrstuvwxyz 語語語 abc"), (2, text[:500]), (8, "é" * 30)]:
        b = np.frombuffer(t.encode(), np.uint8)
        n, form, out, p, m = M.cut_row(d, t.encode(), b, 1, 90, 20)
        assert (n, form, p, m, out.tobytes().decode()) == expected(d, t)


def test_piece_table_cuts_and_permutations():
    t = M.PieceTable((b"abcdef", b"XY"), [(0, 0, 3), (1, 0, 2), (0, 3, 6)])
    assert t.tobytes() == b"abcXYdef"
    c = t.cut((0, 1, 4, 4, 8))
    assert c.tobytes() == b"abcXYdef" and len(c.pieces) == 8
    order = [7, 3, 1, 0, 2, 6, 5, 4]
    assert c.take(order).take(M.inverse(order)).pieces == c.pieces


def test_empty_table_and_other_rates(docs_of, spark):
    odd = spark.createDataFrame([(None, "psm"), ("no marks", "spm"), ("x", None), (None, None)], "output string, form string")
    assert sorted(r.restored_text for r in M.restore(odd).collect()) == ["", "", "no marks", "x"]
    assert M.arrange(docs_of([])).collect() == []
    assert M.restore(M.arrange(docs_of([]))).collect() == []
    rows = [(i, "some words to cut") for i in range(50)]
    assert {r.form for r in M.arrange(docs_of(rows), plain_from=100, spm_below=0).collect()} == {"psm"}
    assert {r.form for r in M.arrange(docs_of(rows), plain_from=0).collect()} == {"plain"}
