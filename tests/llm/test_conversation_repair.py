import functools
import hashlib
import random
import re
import zlib

import pytest

from tessera.llm import conversation_repair as R
from tests.conftest import SF0001

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(initials, faults):
    """(cost, edits) by trying everything; three insertions in a row never help."""
    @functools.cache
    def best(i, q, ins):
        ways = [(0, "")] if i == len(initials) and q in ("", "a") else []
        def go(edit, cost, i2, q2, ins2=0):
            c, rest = best(i2, q2, ins2)
            ways.append((cost + c, edit + rest))
        if ins < 3:
            for r in "ua":
                if (q, r) in NEXT:
                    go("I", 2, i, NEXT[q, r], ins + 1)
        if i < len(initials):
            go("D", 3, i + 1, q)
            if faults[i] != R.MUST_GO:
                t = faults[i] == R.CUT_OFF
                if (q, initials[i]) in NEXT:
                    go("K", t, i + 1, NEXT[q, initials[i]])
                for r in "ua":
                    if (q, r) in NEXT:
                        go("R", 2 + t, i + 1, NEXT[q, r])
        return min(ways, default=(10 ** 9, ""))
    return best(0, "", 0)


def brute(rows):
    """The contract's row of one conversation: ``turn, role, text`` after damage, sorted."""
    seen, c, faults = set(), dict.fromkeys(R.COUNTS, 0), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            c[kind] += 1
        faults.append({None: 0, "truncated": R.CUT_OFF}.get(kind, R.MUST_GO))
    t = [r[0] for r in rows if r[0] is not None]
    c["gaps"] = max(t) - min(t) + 1 - len(set(t)) if t else 0
    ini = [r[1][:1] for r in rows]
    c["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:]))
    c["cost"], audit = cheapest("".join(x or "?" for x in ini), faults)
    out, q, k = [], "", 0
    for e in audit:
        if e != "D":
            new = rows[k][1] if e == "K" else {"": "user", "s": "user", "u": "assistant", "a": "user"}[q]
            out.append(f"{new}:{'' if e == 'I' else rows[k][2]}")
            q = new[0]
        k += e != "I"
    return (*(c[x] for x in R.COUNTS), audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def expected(rows, after):
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        want[conv] = brute(mine)
    return want


def made(rng, n, longest):
    texts = ["Fine.", "Really?", "cut off", "  ", "", "Yes!", "And\n", "Done. \t", "Ünï.", "no end…", "\x0b", None, "Long answer, with commas. "]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Umbrella", "user"])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, rng.choice(texts) if rng.random() < .5 else f"Text {rng.randrange(9)}."))
    return rows


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_search_is_cheapest_and_ascii_least():
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randrange(0, 9)
        ini = "".join(rng.choice("uuaas?") for _ in range(n))
        faults = [rng.choice([0, 0, 0, R.MUST_GO, R.CUT_OFF]) for _ in range(n)]
        assert R.search(ini, faults) == cheapest(ini, faults), (ini, faults)


@pytest.mark.parametrize("ini", ["u", "a", "s", "ua", "uuas", "usa", "aau?"])
def test_search_of_long_runs_stays_small(ini):
    n = 12_000
    cost, audit = R.search((ini * n)[:n], [0, 0, 2][:3] * (n // 3))
    assert sum(x in "DKR" for x in audit) == n and cost <= 5 * n


def test_query_against_brute_force(spark):
    from tessera.llm.queries_more import op13_conversation_repair
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = op13_conversation_repair(spark, SF0001)
    assert df.columns == ["conv_id", *R.COUNTS, "audit", "repaired_sha256"]
    assert got(df) == expected(rows, damaged(rows))


def test_odd_rows_against_brute_force(spark):
    rng = random.Random(7)
    rows = made(rng, 60, 12) + [(None, 1, "user", "No id."), (None, None, "assistant", "Nor turn."), (500, 3, "user", None)]
    rows += [r for r in rows if r[0] == 3] * 2                       # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as key", "1 as gone", "'y' as cost", "2 as block")
    want = expected(rows, damaged(rows))
    assert got(R.repair(R.damage(df), gone_col="gone")) == want and len(want) == 62
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(R.repair(df)) == expected(rows, plain)
    assert R.repair(df.where("false")).collect() == []


def test_all_rows_gone(spark):
    df = spark.createDataFrame([(c, t, "user", "Hello.") for c in range(40) for t in range(1)], SCHEMA)
    g = got(R.repair(R.damage(df), gone_col="gone"))
    assert len(g) == 40 and (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in g.values()


def test_long_conversations_in_blocks_equal_the_whole(spark, monkeypatch):
    rng = random.Random(9)
    rows = made(rng, 25, 30) + [(None, k % 7, "system" if k < 3 else "user", "Same words." if k % 2 else f"Words {k}") for k in range(25)]
    rows += [(600, 5, "user", "Said again and again.")] * 300
    rows += [(601, k, "system", "  " if k else "Only once.") for k in range(20)] + [(602, k, "tool", "") for k in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = got(R.repair(df))
    turns = sorted(map(tuple, R.repair(df, turns=True).collect()), key=str)
    monkeypatch.setattr(R, "LONG_ROWS", 4)
    monkeypatch.setattr(R, "BLOCK_ROWS", 3)
    assert got(R.repair(df)) == want
    assert sorted(map(tuple, R.repair(df, turns=True).collect()), key=str) == turns


def test_turns_give_the_hash(spark):
    df = R.damage(spark.read.parquet(f"{SF0001}/conversations.parquet"))
    text = {}
    for r in sorted(R.repair(df, gone_col="gone", turns=True).collect(), key=lambda r: r.n):
        text.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in R.repair(df, gone_col="gone").collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(text.get(r.conv_id, [])).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in text.get(r.conv_id, [])))
