"""Repair of damaged conversations by iterative-deepening A*.

A conversation is its rows by turn (nulls first; rows of one turn by role, then
text).  Each row's first fault counts: blank (only white space), duplicate (role
and text stood earlier), truncated (the last visible character ends no sentence).
Edits turn the rows into roles ``(s?(ua)+)?``: Keep 0, Rerole to user or assistant
2, Delete 3 (the only edit of blank and duplicate rows), Insert an empty user or
assistant text 2; a truncated row that stays adds 1.

``search`` walks the edits depth first in ASCII order under a growing cost bound.
Its lower bound on what is left comes from one backward sweep over a looser rule
(a conversation may also end after its system text); states that failed keep the
bound they failed with in a transposition table, so no state is searched twice
under one bound.  The first accepting path is the answer: the cheapest edits, and
of those the ASCII-least.

Conversations meet in one shuffle and stream through their task, one at a time.
Those over ``LONG_ROWS`` rows or ``LONG_BYTES`` bytes are never held whole: their
rows are range-partitioned, cut into blocks, each block is searched from every
state to every state, and only the blocks' costs are chained.  Insertions at a
block's end belong to the next block, so of two different edit strings of a block
neither begins the other, and the least whole is made of least parts.

Defined cases: a null role or text is one space, a null id is a conversation of
its own, null turns come first and make no gap; a role without one of the
initials s, u, a can't be kept; repeated rows are duplicates; a conversation all of
whose rows are gone, and an empty table, give zeros and no rows; only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep
from tessera.session import cut_lineage

#: Conversations beyond these are cut into blocks of at most BLOCK_ROWS rows and BLOCK_BYTES bytes.
LONG_ROWS, LONG_BYTES = 20_000, 64 << 20
BLOCK_ROWS, BLOCK_BYTES = 4_096, 32 << 20

#: Costs of the edits, and the states (0 nothing yet, 1 after system, 2 after user, 3 after assistant).
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLE = {2: "user", 3: "assistant"}
#: What an inserted or reroled text makes of a state.
FORCED = (2, 2, 3, 2)
INF = 1 << 60

MUST_GO, CUT_OFF = 1, 2
#: Java regular expression: a visible character.
VISIBLE = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SUMMARY = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
TURNS = "conv_id bigint, n bigint, edit string, role string, text string"


# ------------------------------------------------------------------ search
def _left(initials: str, faults: list[int], ends, tail: bool) -> tuple[list[int], list[int], list[int]]:
    """Lower bounds on the cost from row i on: from nothing, where a user is due, where an assistant is due."""
    n = len(initials)
    start, user, asst = [INF] * (n + 1), [INF] * (n + 1), [INF] * (n + 1)
    start[n] = 0 if 0 in ends else INF
    user[n] = 0 if 1 in ends or 3 in ends else INF
    asst[n] = 0 if 2 in ends else INF
    for i in range(n, -1, -1):
        if i < n:
            s1, u1, a1 = start[i + 1], user[i + 1], asst[i + 1]
            s, u, a = DELETE + s1, DELETE + u1, DELETE + a1
            if faults[i] != MUST_GO:
                t, c = TRUNCATED * (faults[i] == CUT_OFF), initials[i]
                to_u, to_a = t + (0 if c == "u" else REROLE), t + (0 if c == "a" else REROLE)
                s, u, a = min(s, to_u + a1, t + u1 if c == "s" else INF), min(u, to_u + a1), min(a, to_a + u1)
            start[i], user[i], asst[i] = s, u, a
        if i < n or tail:
            user[i], asst[i] = min(user[i], INSERT + asst[i]), min(asst[i], INSERT + user[i])
            start[i] = min(start[i], INSERT + asst[i])
    return start, user, asst


def search(initials: str, faults: list[int], begin: int = 0, ends=ENDS, tail: bool = True) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest way from ``begin`` to one of ``ends``, ties ASCII-least.

    Without ``tail`` nothing is inserted after the last row.  None if there is no way.
    """
    n = len(initials)
    start, user, asst = _left(initials, faults, ends, tail)
    first = (start, user, asst, user)
    failed: dict[int, int] = {}                         # state -> cost that is needed at least, learned by failing

    def least(i: int, q: int) -> int:
        return failed.get(4 * i + q, first[q][i])

    def edits(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, q
        if i < n or tail:
            yield "I", INSERT, i, FORCED[q]
        if i < n and faults[i] != MUST_GO:
            t = TRUNCATED * (faults[i] == CUT_OFF)
            if initials[i] in NEXT[q]:
                yield "K", t, i + 1, NEXT[q][initials[i]]
            yield "R", REROLE + t, i + 1, FORCED[q]

    bound = least(0, begin)
    while bound < INF:
        # a frame: row, state, cost so far, edits still to try, least cost seen beyond, edit that led here and its cost
        stack = [[0, begin, 0, edits(0, begin), INF, "", 0]]
        while stack:
            frame = stack[-1]
            i, q, g, todo, beyond, _, _ = frame
            if i == n and q in ends:
                return g, "".join(f[5] for f in stack)
            for e, cost, i2, q2 in todo:
                if g + cost + least(i2, q2) <= bound:
                    stack.append([i2, q2, g + cost, edits(i2, q2), INF, e, cost])
                    break
                beyond = min(beyond, cost + least(i2, q2))
            else:
                failed[4 * i + q] = max(least(i, q), beyond)
                stack.pop()
                if stack:
                    stack[-1][4] = min(stack[-1][4], frame[6] + failed[4 * i + q])
                continue
            frame[4] = beyond
        bound = least(0, begin)
    return None


def between(initials: str, faults: list[int]) -> dict[tuple[int, int], tuple[int, str]]:
    """``search`` of a block from each state to each state."""
    n, out = len(initials), {}
    for q in (0, 1):                                    # nothing is kept
        out[q, q] = (DELETE * n, "D" * n)
    kept = [(TRUNCATED * (faults[i] == CUT_OFF), -i) for i in range(n) if initials[i] == "s" and faults[i] != MUST_GO]
    if kept:                                            # only a system text is kept; the later the more deletions come first
        t, i = min(kept)
        out[0, 1] = (DELETE * (n - 1) + t, "D" * -i + "K" + "D" * (n - 1 + i))
    for q in range(4):
        for r in (2, 3):
            found = search(initials, faults, q, (r,), tail=False)
            if found:
                out[q, r] = found
    return out


def replay(edits: str, rows: list[tuple[str, str]], state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what stays or comes in."""
    i = 0
    for e in edits:
        if e == "D":
            i += 1
            continue
        if e == "K":
            role, text = rows[i]
            state = NEXT[state][role[:1]]
        else:
            state = FORCED[state]
            role, text = ROLE[state], ("" if e == "I" else rows[i][1])
        i += e != "I"
        yield e, role, text


class Digest:
    """SHA-256 of ``role:text`` lines, fed one by one."""

    def __init__(self):
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


# ------------------------------------------------------------------ conversations that one task holds
def _summarise(rows: list[tuple]) -> tuple[dict, str, list[tuple[str, str]], list[int]]:
    """Counts, initials, (role, text) and faults of a conversation's sorted rows
    ``turn, role, text, blank, truncated``."""
    c, seen, faults = dict.fromkeys(COUNTS, 0), set(), []
    for _, role, text, blank, truncated in rows:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        name = "blank" if blank else "duplicate" if key in seen else "truncated" if truncated else None
        seen.add(key)
        if name:
            c[name] += 1
        faults.append(0 if name is None else CUT_OFF if name == "truncated" else MUST_GO)
    turns = [r[0] for r in rows if r[0] is not None]
    if turns:
        c["gaps"] = max(turns) - min(turns) + 1 - len(set(turns))
    initials = "".join(r[1][:1] or "?" for r in rows)
    c["illegal"] = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
    return c, initials, [(r[1], r[2]) for r in rows], faults


def _one(conv_id, rows: list[tuple]) -> tuple[tuple, list[tuple[str, str, str]]]:
    c, initials, texts, faults = _summarise(rows)
    c["cost"], audit = search(initials, faults)
    after, d = list(replay(audit, texts)), Digest()
    for _, role, text in after:
        d.add(role, text)
    return (conv_id, *(c[x] for x in COUNTS), audit, d.sha.hexdigest()), after


def _conversations(batches) -> Iterator[tuple[int | None, list[tuple]]]:
    """Conversations of sorted batches, one at a time; rows that are gone only name theirs."""
    now, rows, any_row = None, [], False
    for batch in batches:
        for k in range(0, batch.num_rows, 1024):
            part = batch.slice(k, 1024).to_pydict()
            for conv_id, gone, *row in zip(part["conv_id"], part["gone"], part["turn"], part["role"], part["text"], part["blank"], part["truncated"]):
                if any_row and conv_id != now:
                    yield now, rows
                    rows = []
                now, any_row = conv_id, True
                if not gone:
                    rows.append(tuple(row))
    if any_row:
        yield now, rows


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _ordinary(turns: bool):
    names = [f.split()[0] for f in (TURNS if turns else SUMMARY).split(", ")]
    types = [pa.int64() if f.endswith("bigint") else pa.string() for f in (TURNS if turns else SUMMARY).split(", ")]

    def run(batches):
        out, size = [], 0
        for conv_id, rows in _conversations(batches):
            line, after = _one(conv_id, rows)
            if turns:
                out += [(conv_id, k, *x) for k, x in enumerate(after)]
                size += sum(len(x[2]) for x in after)
            else:
                out.append(line)
            if len(out) >= 2048 or size > 1 << 22:
                yield _table(out, names, types)
                out, size = [], 0
        yield _table(out, names, types)
    return run


# ------------------------------------------------------------------ conversations over the limits
def _judged(rows: DataFrame) -> DataFrame:
    """Rows of long conversations with their fault; a text that has to go is null.

    Equal rows are counted where they are read, and come apart again in two steps, so
    neither a text said a million times nor its copies meet in one task.
    """
    named = rows.where("NOT gone").groupBy("key", "conv_id", "turn", "role", "text", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    named = named.withColumn("mark", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    at = F.struct(F.col("turn").isNotNull().alias("is_set"), "turn")
    first = named.groupBy(F.col("key").alias("k"), F.col("mark").alias("m")).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    j = named.join(first, (F.col("key") == F.col("k")) & (F.col("mark") == F.col("m")), "left")
    j = j.withColumn("again", F.col("first").isNotNull() & ~(F.struct(F.col("turn").isNotNull().alias("is_set"), "turn").eqNullSafe(F.col("first"))))
    step = 4096
    j = j.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / step))))
    j = j.withColumn("copy", F.explode(F.sequence(F.col("lot") * step, F.least(F.col("copies"), (F.col("lot") + 1) * step) - 1)))
    duplicate = F.col("again") | (F.col("copy") > 0)
    fault = F.when(F.col("blank"), "blank").when(duplicate, "duplicate").when(F.col("truncated"), "truncated")
    return j.select("key", "conv_id", "turn", "role", "mark", "copy", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"),
                    F.when(~(F.col("blank") | duplicate), F.col("text")).alias("said"), F.col("text").alias("by_text"))


def _placed(judged: DataFrame) -> DataFrame:
    """Rows in order, with the block they stand in (partition, then number) and their place there."""
    n = judged.sparkSession.conf.get("spark.sql.shuffle.partitions")
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("by_text"), F.col("copy")]
    dealt = judged.repartitionByRange(int(n), *order).sortWithinPartitions(*order).drop("by_text", "mark", "copy")
    schema = "key string, conv_id bigint, turn bigint, role string, initial string, fault string, said string, block bigint, place int"

    def run(batches):
        part = TaskContext.get().partitionId() << 32
        block, place, size, now = -1, 0, 0, None
        for batch in batches:
            keys, said = batch.column("key").to_pylist(), batch.column("said")
            sizes = pa.compute.fill_null(pa.compute.binary_length(said), 0).to_pylist()
            blocks, places = [], []
            for key, s in zip(keys, sizes):
                if key != now or place >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    block, place, size, now = block + 1, 0, 0, key
                blocks.append(part | block)
                places.append(place)
                place, size = place + 1, size + s
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "conv_id", "turn", "role", "initial", "fault", "said")]
                + [pa.array(blocks, pa.int64()), pa.array(places, pa.int32())],
                names=["key", "conv_id", "turn", "role", "initial", "fault", "said", "block", "place"])
    return cut_lineage(dealt.mapInArrow(run, schema))


def _solve_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("place")
    initials = "".join(x or "?" for x in pdf["initial"])
    faults = [0 if f is None else CUT_OFF if f == "truncated" else MUST_GO for f in pdf["fault"].where(pdf["fault"].notna(), None)]
    ways = between(initials, faults)
    order = {e: k for k, e in enumerate(sorted({e for _, e in ways.values()}))}
    illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
    return pd.DataFrame([(*key, initials[0], initials[-1], illegal, q, r, cost, order[e], sum(x != "D" for x in e), e) for (q, r), (cost, e) in ways.items()],
                        columns=["key", "block", "head", "last", "illegal", "q", "r", "cost", "rank", "lines", "edits"])


SOLVED = "key string, block bigint, head string, last string, illegal bigint, q int, r int, cost bigint, rank int, lines bigint, edits string"
CHOSEN = "key string, block bigint, q int, r int, before bigint, cost bigint, illegal bigint, tail string"


def _chain(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The way through a conversation's blocks: cheapest, ties by the first block whose edits are less."""
    blocks = [(b, g) for b, g in pdf.sort_values("block").groupby("block", sort=True)]
    tails = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
    left = [dict() for _ in blocks] + [{q: c for q, (c, _) in tails.items()}]
    for k in range(len(blocks) - 1, -1, -1):
        for q, r, cost in zip(blocks[k][1]["q"], blocks[k][1]["r"], blocks[k][1]["cost"]):
            if r in left[k + 1]:
                left[k][q] = min(left[k].get(q, INF), cost + left[k + 1][r])
    q, before, out, total, last = 0, 0, [], left[0][0], None
    for k, (b, g) in enumerate(blocks):
        ways = [(rank, r, lines) for q0, r, cost, rank, lines in zip(g["q"], g["r"], g["cost"], g["rank"], g["lines"])
                if q0 == q and cost + left[k + 1].get(r, INF) == left[k][q]]
        _, r, lines = min(ways)
        illegal = g["illegal"].iloc[0] + (last is not None and not legal(last, g["head"].iloc[0]))
        last = g["last"].iloc[0]
        out.append((key[0], b, q, r, before, total if k == 0 else 0, illegal, ""))
        q, before = r, before + lines
    out[-1] = (*out[-1][:-1], tails[q][1])
    return pd.DataFrame(out, columns=["key", "block", "q", "r", "before", "cost", "illegal", "tail"])


def _pieces(rows: pd.DataFrame) -> pd.DataFrame:
    """The edits of one block, which its first row carries, applied."""
    rows = rows.sort_values("place")
    w = rows.iloc[0]
    texts = [(r, t) for r, t in zip(rows["role"], rows["said"])]
    after = list(replay(w["edits"] + w["tail"], texts, int(w["q"])))
    conv, before = rows["conv_id"].iloc[0], int(w["before"])
    conv = None if pd.isna(conv) else int(conv)
    return pd.DataFrame([(w["key"], conv, before + k, *x) for k, x in enumerate(after)], columns=["key", "conv_id", "n", "edit", "role", "text"], dtype=object)


def _hash_stream(batches):
    """One row for each key of rows sorted by key and n: edits without deletions are not kept, only the hash."""
    now, d = None, None
    done: list[tuple[str, str]] = []
    for batch in batches:
        for k in range(0, batch.num_rows, 1024):
            part = batch.slice(k, 1024).to_pydict()
            for key, role, text in zip(part["key"], part["role"], part["text"]):
                if key != now:
                    if d:
                        done.append((now, d.sha.hexdigest()))
                    now, d = key, Digest()
                d.add(role, text)
    if d:
        done.append((now, d.sha.hexdigest()))
    yield _table(done, ["key", "repaired_sha256"], [pa.string(), pa.string()])


def _edits_stream(batches):
    """Each conversation's edits, joined in block order."""
    now, parts, done = None, [], []
    for batch in batches:
        d = batch.to_pydict()
        for key, edits in zip(d["key"], d["edits"]):
            if key != now:
                if now is not None:
                    done.append((now, "".join(parts)))
                now, parts = key, []
            parts.append(edits)
    if now is not None:
        done.append((now, "".join(parts)))
    yield _table(done, ["key", "audit"], [pa.string(), pa.string()])


def _long(rows: DataFrame, turns: bool) -> DataFrame:
    placed = _placed(_judged(rows))
    solved = keep(placed.select("key", "block", "place", "initial", "fault").groupBy("key", "block").applyInPandas(_solve_block, SOLVED))
    chosen = keep(solved.drop("edits").groupBy("key").applyInPandas(_chain, CHOSEN))
    ways = solved.select("key", "block", "q", "r", "edits").join(chosen, ["key", "block", "q", "r"])
    carried = placed.select("key", "conv_id", "block", "place", "role", "said").join(ways.withColumn("place", F.lit(0)), ["key", "block", "place"], "left")
    pieces = carried.groupBy("key", "block").applyInPandas(_pieces, "key string, conv_id bigint, n bigint, edit string, role string, text string")
    if turns:
        return pieces.drop("key")
    by_key = F.col("key")
    sha = pieces.select("key", "n", "role", "text").repartition(by_key).sortWithinPartitions("key", "n").mapInArrow(_hash_stream, "key string, repaired_sha256 string")
    audit = (ways.select("key", "block", F.concat("edits", "tail").alias("edits")).repartition(by_key).sortWithinPartitions("key", "block")
             .mapInArrow(_edits_stream, "key string, audit string"))
    count = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    distinct = placed.groupBy("key", "turn").agg(F.first("conv_id").alias("conv_id"), *[count(f) for f in ("blank", "duplicate", "truncated")])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    c = distinct.groupBy("key").agg(F.first("conv_id").alias("conv_id"), gaps.alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    total = chosen.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    empty = F.sha2(F.lit(""), 256)
    return (c.join(total, "key").join(audit, "key").join(sha, "key", "left")
            .select("conv_id", *COUNTS, "audit", F.coalesce("repaired_sha256", empty).alias("repaired_sha256")))


# ------------------------------------------------------------------ interface
def _rows(conversations: DataFrame, cols: tuple[str, str, str, str], gone_col: str | None) -> DataFrame:
    conv, turn, role, text = (F.col(c) for c in cols)
    gone = F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)
    r = conversations.select(conv.cast("bigint").alias("conv_id"), turn.cast("bigint").alias("turn"),
                             F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"), gone.alias("gone"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    return r.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", "turn", "role",
                    F.when(~F.col("gone"), F.col("text")).alias("text"), "gone",
                    (~F.col("text").rlike(VISIBLE)).alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))


def repair(conversations: DataFrame, cols: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
           gone_col: str | None = None, turns: bool = False) -> DataFrame:
    """One row for each conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``; with ``turns`` the repaired conversations instead, one
    row for each text: ``conv_id, n, edit, role, text``.

    A row whose ``gone_col`` is true only names its conversation.
    """
    rows = _rows(conversations, cols, gone_col)
    size = rows.where("NOT gone").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = keep(size.where((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select("key"))
    some = long.limit(1).count() > 0
    ordinary = rows.join(long, "key", "left_anti") if some else rows
    out = (ordinary.drop("key").repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
           .mapInArrow(_ordinary(turns), TURNS if turns else SUMMARY))
    return out.unionByName(_long(rows.join(long, "key", "left_semi"), turns)) if some else out


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by crc32 of ``conv_id:turn`` modulo 20
    (0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes
    it the user's); nulls are one space."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    d = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), h.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("h") == 0).alias("gone"), times.alias("copy")).drop("copy")
