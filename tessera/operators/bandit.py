"""Contextual bandits: LinUCB statistics, scoring, replay evaluation (B3, B4, B6,
B7, C5, D10-D12, E1, E7, G9, I1-I11).

Log rows: ``t, z (user features), chosen, reward, choices``.  Arms:
``arm, x``.  The arm table and the per-arm statistics are model-sized
(arms x d^2); they are size-checked before being shipped to tasks.

Policy kinds (feature layouts of the four reference policies):

============== ===================== ====================== ============
kind           per-arm context x      shared context z       reward 0
============== ===================== ====================== ============
disjoint       user                   -                      kept 0
concat         [user || article]      -                      kept 0
hybrid_concat  [article || user]      user                   kept 0
hybrid         user                   user (x) article (36)  recoded -1
============== ===================== ====================== ============

Order-free training: for a fixed set of accepted rows the final LinUCB
state is a sum per arm (A = I + sum x x^T, B = sum x z^T, b = sum r x) plus
the shared A0 = I + sum z z^T - sum_a B_a^T A_a^-1 B_a and
b0 = sum r z - sum_a B_a^T A_a^-1 b_a (the reference's add/subtract
updates telescope).  So training is one distributed aggregation; only the
choice of accepted rows depends on log order.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.features import concat_features, interaction_features
from tessera.functions.hashing import py_uniform
from tessera.operators.partial import matrix, sums_by_key
from tessera.sources.parallel import by_key, spread

MAX_ARMS = 100_000
#: segments whose totals are summed together
CARRY = 1 << 16


@dataclass(frozen=True)
class LinUcbPolicy:
    """H5: the policy interface (set_articles / recommend / update) as data."""
    kind: str = "disjoint"
    alpha: float = 0.2
    recode: bool | None = None  # None -> the kind's default (True only for 'hybrid')

    @property
    def hybrid(self) -> bool:
        return self.kind in ("hybrid", "hybrid_concat")

    @property
    def recodes(self) -> bool:
        return self.kind == "hybrid" if self.recode is None else self.recode


def check_arms(arms: DataFrame) -> int:
    n = arms.count()
    if n > MAX_ARMS:
        raise ValueError(f"{n} arms exceed the model size bound")
    return n


def arms_side(arms: DataFrame) -> DataFrame:
    """The arm table as a join side: broadcast only when its row count is checked small."""
    return F.broadcast(arms) if check_arms(arms) <= 10_000 else arms


def arms_dict(arms: DataFrame) -> dict[int, np.ndarray]:
    check_arms(arms)
    return {int(r["arm"]): np.asarray(r["x"], dtype=np.float64) for r in arms.collect()}


# ------------------------------------------------------------------ features
def x_of(kind: str, user: np.ndarray, art: np.ndarray) -> np.ndarray:
    if kind == "disjoint" or kind == "hybrid":
        return user
    if kind == "concat":
        return np.concatenate([user, art], axis=-1)
    if kind == "hybrid_concat":
        return np.concatenate([art, user], axis=-1)
    raise ValueError(kind)


def z_of(kind: str, user: np.ndarray, art: np.ndarray) -> np.ndarray | None:
    if kind == "hybrid_concat":
        return user
    if kind == "hybrid":
        return (user[..., :, None] * art[..., None, :]).reshape(*user.shape[:-1], -1)
    return None


def x_col(kind: str, user, art):
    if kind in ("disjoint", "hybrid"):
        return user
    if kind == "concat":
        return concat_features(user, art)
    return concat_features(art, user)


def z_col(kind: str, user, art):
    if kind == "hybrid_concat":
        return user
    if kind == "hybrid":
        return interaction_features(user, art)
    return None


# ------------------------------------------------------------------ C5 / B6 / B7
def choices_arms_join(log: DataFrame, arms: DataFrame) -> DataFrame:
    """One row per (event, candidate position) with the arm features.

    The arm table is broadcast only after its size is checked.
    """
    a = arms_side(arms)
    e = log.select("t", "z", "chosen", "reward", F.posexplode("choices").alias("pos", "arm"))
    return e.join(a.select("arm", F.col("x").alias("ax")), "arm")


# ------------------------------------------------------------------ B3 / B4
def reward_recode(reward):
    """Reward 0 -> -1 (the final hybrid policy learns from -1/+1)."""
    return F.when(reward == 0, F.lit(-1)).otherwise(reward)


# ------------------------------------------------------------------ D11 / D12
#: key of the shared sums
SHARED = -1


def _shapes(dx: int, dz: int) -> tuple[dict, dict]:
    """Shapes of an arm's statistics and of the shared ones, in the order of their arrays."""
    own = {"xx": (dx, dx), "rx": (dx, 1)} | ({"xz": (dx, dz)} if dz else {})
    return own, ({"zz": (dz, dz), "rz": (dz, 1)} if dz else {})


def row_sums(kind: str, arm: np.ndarray, r: np.ndarray, user: np.ndarray, art: np.ndarray):
    """(arm, array) of the sums of some rows for each of their arms and, for hybrids, for ``SHARED``."""
    X, Z = x_of(kind, user, art), z_of(kind, user, art)
    order = np.argsort(arm, kind="stable")
    at = np.flatnonzero(np.append(True, arm[order][1:] != arm[order][:-1]))
    for s, e in zip(at, np.append(at[1:], len(arm))):
        i = order[s:e]
        stats = [(X[i].T @ X[i]).ravel(), r[i] @ X[i]] + ([(X[i].T @ Z[i]).ravel()] if Z is not None else [])
        yield int(arm[i[0]]), np.concatenate(stats)
    if Z is not None:
        yield SHARED, np.concatenate([(Z.T @ Z).ravel(), r @ Z])


def linucb_arrays(accepted: DataFrame, arms: DataFrame, policy: LinUcbPolicy) -> DataFrame:
    """Sums of a set of accepted rows (``t, z, chosen, reward``): ``arm, sums``, one array for
    each arm (xx, rx and for hybrids xz, flattened) and, for hybrids, one under
    ``SHARED`` (zz, rz).  No identity is added.

    A task adds its rows up by matrix products, so a hot arm costs one array a task.
    """
    a = arms_side(arms)
    r = spread(accepted).join(a.select(F.col("arm").alias("chosen"), F.col("x").alias("ax")), "chosen")
    rew = reward_recode(F.col("reward")) if policy.recodes else F.col("reward")
    r = r.select(F.col("chosen").cast("bigint").alias("arm"), rew.cast("double").alias("r"), F.col("z").cast("array<double>").alias("z"),
                 F.col("ax").cast("array<double>").alias("ax"))
    kind = policy.kind

    def part(b):
        return row_sums(kind, np.asarray(b.column(0)), np.asarray(b.column(1)), matrix(b.column(2)), matrix(b.column(3)))
    return sums_by_key(r, part).withColumnRenamed("key", "arm")


def linucb_sums(accepted: DataFrame, arms: DataFrame, policy: LinUcbPolicy) -> DataFrame:
    """The same in long form ``arm, stat, i, j, v`` (arm null for the shared sums)."""
    st = LinUcbState(policy, arms_dict(arms))
    own, shared = _shapes(*st.dims())

    def cell(stat, m):
        return lambda v, p: F.struct(F.lit(stat).alias("stat"), F.floor(p / m).cast("int").alias("i"), (p % m).cast("int").alias("j"), v.alias("v"))

    def cells(shapes):
        out, at = [], 0
        for stat, (n, m) in shapes.items():
            out.append(F.transform(F.slice("sums", at + 1, n * m), cell(stat, m)))
            at += n * m
        return F.concat(*out)
    sums = linucb_arrays(accepted, arms, policy)
    c = F.when(F.col("arm") == SHARED, cells(shared)).otherwise(cells(own)) if shared else cells(own)
    return sums.select(F.when(F.col("arm") != SHARED, F.col("arm")).alias("arm"), F.explode(c).alias("c")).select("arm", "c.*")


@dataclass
class LinUcbState:
    """Model-sized LinUCB state: per-arm A, b (and B), shared A0, b0."""
    policy: LinUcbPolicy
    arm_x: dict
    A: dict = field(default_factory=dict)
    b: dict = field(default_factory=dict)
    B: dict = field(default_factory=dict)
    A0: np.ndarray | None = None
    b0: np.ndarray | None = None
    user_dim: int = 6

    def dims(self):
        if self.policy.kind in ("epsilon_greedy", "ucb1"):
            return 0, 0
        any_arm = next(iter(self.arm_x.values()))
        u = np.zeros(self.user_dim)
        dx = x_of(self.policy.kind, u, any_arm).shape[-1]
        z = z_of(self.policy.kind, u, any_arm)
        return dx, (z.shape[-1] if z is not None else 0)

    def arm(self, a):
        dx, dz = self.dims()
        if a not in self.A:
            self.A[a] = np.eye(dx)
            self.b[a] = np.zeros(dx)
            if dz:
                self.B[a] = np.zeros((dx, dz))
        return self.A[a], self.b[a], self.B.get(a)


def state_from_arrays(sums: dict[int, np.ndarray], arm_x: dict, policy: LinUcbPolicy) -> LinUcbState:
    """The state of the aggregated sums (telescoped hybrid form)."""
    st = LinUcbState(policy, arm_x)
    dx, dz = st.dims()
    own, shared = _shapes(dx, dz)

    def cut(v, shapes):
        out, at = {}, 0
        for stat, (n, m) in shapes.items():
            out[stat] = np.asarray(v[at:at + n * m]).reshape(n, m)
            at += n * m
        return out
    for a in sorted(sums):
        if a != SHARED:
            c = cut(sums[a], own)
            st.A[a], st.b[a] = np.eye(dx) + c["xx"], c["rx"][:, 0].copy()
            if dz:
                st.B[a] = c["xz"].copy()
    if dz:
        c = cut(sums[SHARED], shared) if SHARED in sums else {"zz": np.zeros((dz, dz)), "rz": np.zeros((dz, 1))}
        st.A0, st.b0 = np.eye(dz) + c["zz"], c["rz"][:, 0].copy()
        for a in st.A:
            BtAi = np.linalg.solve(st.A[a], st.B[a]).T
            st.A0 -= BtAi @ st.B[a]
            st.b0 -= BtAi @ st.b[a]
    return st


def collect_arrays(sums: DataFrame) -> dict[int, np.ndarray]:
    """The arrays on the driver: one for each arm, at most ``MAX_ARMS`` of them."""
    rows = sums.limit(MAX_ARMS + 2).collect()
    if len(rows) > MAX_ARMS + 1:
        raise ValueError("statistics exceed the model size bound")
    return {int(r["arm"]): np.array(r["sums"]) for r in rows}


def state_long(spark, st: LinUcbState) -> DataFrame:
    """State as ``arm, stat, i, j, v`` (arm null for the shared A0, b0)."""
    rows: list[tuple] = []

    def add(arm, stat, m):
        m = m if m.ndim == 2 else m[:, None]
        rows.extend((arm, stat, i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]))

    for a in sorted(st.A):
        add(int(a), "A", st.A[a])
        add(int(a), "b", st.b[a])
        if a in st.B:
            add(int(a), "B", st.B[a])
    if st.A0 is not None:
        add(None, "A0", st.A0)
        add(None, "b0", st.b0)
    return spark.createDataFrame(rows, "arm bigint, stat string, i int, j int, v double")


def train_state(accepted: DataFrame, arms: DataFrame, policy: LinUcbPolicy) -> LinUcbState:
    return state_from_arrays(collect_arrays(linucb_arrays(accepted, arms, policy)), arms_dict(arms), policy)


# ------------------------------------------------------------------ scoring
def _best(sc: np.ndarray) -> np.ndarray:
    """Place of each row's first maximum (the first candidate wins ties), -1 where it is not finite."""
    best = sc.argmax(1)
    return np.where(np.isfinite(sc[np.arange(len(sc)), best]), best, -1)


class _Scorer:
    """UCB scoring over a live LinUCB state.

    Per-arm quantities are kept as stacked arrays (arms x d x d), so the ~20
    candidates of an event are scored by a few batched ``einsum`` calls;
    inverses are refreshed only for the arm that changed (and the shared
    block on hybrid updates).
    """

    def __init__(self, st: LinUcbState):
        self.st = st
        self.kind = st.policy.kind
        self.alpha = st.policy.alpha
        self.hybrid = st.policy.hybrid
        self.dx, self.dz = st.dims()
        arms = sorted(st.arm_x)
        self.index = {a: i for i, a in enumerate(arms)}
        self.art = np.array([st.arm_x[a] for a in arms], dtype=np.float64).reshape(len(arms), -1)
        n = len(arms)
        self.Ainv = np.repeat(np.eye(self.dx)[None], n, axis=0)
        self.b = np.zeros((n, self.dx))
        self.B = np.zeros((n, self.dx, self.dz)) if self.hybrid else None
        for a in st.A:
            self.refresh_arm(a)
        if self.hybrid:
            self.refresh_shared()

    def refresh_shared(self):
        A0 = self.st.A0 if self.st.A0 is not None else np.eye(self.dz)
        b0 = self.st.b0 if self.st.b0 is not None else np.zeros(self.dz)
        self.A0inv = np.linalg.inv(A0)
        self.beta = self.A0inv @ b0

    def refresh_arm(self, a):
        i = self.index.get(a)
        if i is None:
            return
        self.Ainv[i] = np.linalg.inv(self.st.A[a])
        self.b[i] = self.st.b[a]
        if self.hybrid:
            self.B[i] = self.st.B[a]

    def learn(self, arm, user: np.ndarray, reward: float) -> None:
        """One accepted event, by rank-one steps on the state and its inverses.

        The shared block sums what each arm's ridge regression on x leaves
        unexplained of z and r.  A new row adds the outer product of its
        residuals e = z - B'p and r - b'p (p = A^-1 x), divided by
        s = 1 + x'p, so no matrix is inverted.
        """
        i, st = self.index[arm], self.st
        A, b, B = st.arm(arm)
        x = x_of(self.kind, user, self.art[i])
        p = self.Ainv[i] @ x
        s = 1.0 + x @ p
        if self.hybrid:
            z = z_of(self.kind, user, self.art[i])
            e = z - p @ B
            st.A0 += np.outer(e, e) / s
            st.b0 += e * ((reward - b @ p) / s)
            q = self.A0inv @ e
            self.A0inv -= np.outer(q, q) / (s + e @ q)
            self.beta = self.A0inv @ st.b0
            B += np.outer(x, z)
            self.B[i] = B
        A += np.outer(x, x)
        b += reward * x
        self.Ainv[i] -= np.outer(p, p) / s
        self.b[i] = b

    def scores(self, user: np.ndarray, choices) -> np.ndarray:
        """UCB of every candidate (-inf for an arm without features)."""
        out = np.full(len(choices), -np.inf)
        pos = [p for p, a in enumerate(choices) if int(a) in self.index]
        if not pos:
            return out
        idx = np.array([self.index[int(choices[p])] for p in pos])
        out[pos] = self._score(np.broadcast_to(user, (len(idx), user.shape[0])), idx)
        return out

    def _score(self, u: np.ndarray, idx: np.ndarray | int) -> np.ndarray:
        """UCB of users and arms (by index, or one arm's), pair by pair; a pair's sums do not depend on the others."""
        one = np.ndim(idx) == 0
        art = np.broadcast_to(self.art[idx], (len(u), self.art.shape[1])) if one else self.art[idx]
        x = x_of(self.kind, u, art)
        Ai = np.broadcast_to(self.Ainv[idx], (len(u), self.dx, self.dx)) if one else self.Ainv[idx]
        Aix = np.einsum("kij,kj->ki", Ai, x)
        if not self.hybrid:
            w = np.einsum("kij,kj->ki", self.Ainv[[idx]], self.b[[idx]]) if one else np.einsum("kij,kj->ki", self.Ainv, self.b)[idx]
            q = np.maximum((x * Aix).sum(1), 0.0)
            return (w * x).sum(1) + self.alpha * np.sqrt(q)
        # with e = z - B'A^-1 x: mean e'beta + b'A^-1 x, variance e'A0^-1 e + x'A^-1 x
        e = z_of(self.kind, u, art) - np.einsum("kji,kj->ki", self.B[idx], Aix)
        q = ((e @ self.A0inv) * e).sum(1) + (x * Aix).sum(1)
        return e @ self.beta + (Aix * self.b[idx]).sum(1) + self.alpha * np.sqrt(np.maximum(q, 0.0))

    def pick_block(self, users: np.ndarray, idx: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """Position of the best candidate of each event under the model as it stands (-1: none);
        ``idx`` has the index of every candidate (events x places, -1 where there is none).
        ``out`` (-inf everywhere) gets the scores."""
        sc = np.full(idx.shape, -np.inf) if out is None else out
        e, p = np.nonzero(idx >= 0)
        if not len(e):
            return np.full(len(idx), -1)
        sc[e, p] = self._score(users[e], idx[e, p])
        return _best(sc)

    def indices(self, choices: list) -> np.ndarray:
        """Candidate lists as a matrix of arm indices, filled up with -1."""
        n = np.array([0 if c is None else len(c) for c in choices], dtype=np.int64)
        out = np.full((len(n), n.max(initial=0)), -1, dtype=np.int64)
        if out.size and self.index:
            flat = np.concatenate([c for c in choices if c is not None and len(c)]).astype(np.int64, copy=False)
            out[np.arange(out.shape[1]) < n[:, None]] = self.places(flat)
        return out

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Indices of arms, -1 for an arm without features."""
        arms = np.fromiter(self.index, dtype=np.int64)          # in order
        if not len(arms):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(arms, ids), len(arms) - 1)
        return np.where(arms[at] == ids, at, -1)

    def ucb(self, user: np.ndarray, arm: int) -> float:
        return float(self.scores(user, [arm])[0])

    def pick(self, user: np.ndarray, choices) -> tuple[int, float, int]:
        if not len(choices):
            return -1, -np.inf, -1
        sc = self.scores(user, choices)
        p = int(np.argmax(sc))  # first maximum: the first candidate wins ties
        if not np.isfinite(sc[p]):
            return -1, -np.inf, -1
        return int(choices[p]), float(sc[p]), p


    def scores_many(self, users: np.ndarray, arms: np.ndarray) -> np.ndarray:
        """UCB of many (user, arm) pairs under a fixed state, an arm at a time."""
        out = np.full(len(arms), -np.inf)
        order = np.argsort(arms, kind="stable")
        at = np.flatnonzero(np.append(True, arms[order][1:] != arms[order][:-1])) if len(arms) else []
        for s, e in zip(at, np.append(at[1:], len(arms))):
            i = self.index.get(int(arms[order[s]]))
            for r in (order[k:min(e, k + 65_536)] for k in range(s, e, 65_536) if i is not None):
                u = users[r]
                art = np.broadcast_to(self.art[i], (len(r), self.art.shape[1]))
                x = x_of(self.kind, u, art)
                Aix = x @ self.Ainv[i]
                if not self.hybrid:
                    out[r] = x @ (self.Ainv[i] @ self.b[i]) + self.alpha * np.sqrt(np.maximum((x * Aix).sum(1), 0.0))
                    continue
                e = z_of(self.kind, u, art) - Aix @ self.B[i]
                q = ((e @ self.A0inv) * e).sum(1) + (x * Aix).sum(1)
                out[r] = e @ self.beta + Aix @ self.b[i] + self.alpha * np.sqrt(np.maximum(q, 0.0))
        return out


#: Events whose candidates are scored together, and those that are played together.
SCORED_EVENTS = 4096
PLAYED_EVENTS = 512
PICK_TYPE = T.StructType([T.StructField("arm", T.LongType()), T.StructField("ucb", T.DoubleType()),
                          T.StructField("pos", T.IntegerType())])


def pick_udf(st: LinUcbState):
    """I1-I3 + E1: score every candidate of an event and take the best (first wins ties).

    The event row carries its candidate list, so no explode and no shuffle are
    needed; the model travels in the closure (model-sized); a batch's candidates
    are scored together, arm by arm.  Without a candidate that has features the
    pick is -1.
    """
    sc = _Scorer(st)

    @F.pandas_udf(PICK_TYPE)
    def _pick(z: pd.Series, choices: pd.Series) -> pd.DataFrame:
        return pick_many(sc, z, choices)

    return _pick


def pick_many(sc: _Scorer, z: pd.Series, choices: pd.Series) -> pd.DataFrame:
    """``arm, ucb, pos`` of the best candidate of every event under a fixed model."""
    n = np.array([0 if c is None else len(c) for c in choices], dtype=np.int64)
    arm, ucb, pos = np.full(len(n), -1), np.full(len(n), -np.inf), np.full(len(n), -1, np.int32)
    if n.sum():
        flat = np.concatenate([np.asarray(c, dtype=np.int64) for c in choices if c is not None and len(c)])
        users = np.repeat(np.stack(z.to_numpy()).astype(np.float64), n, axis=0)
        s = sc.scores_many(users, flat)
        event = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        best = np.lexsort((place, -s, event))
        best = best[np.append(True, event[best][1:] != event[best][:-1])]
        best = best[np.isfinite(s[best])]
        arm[event[best]], ucb[event[best]], pos[event[best]] = flat[best], s[best], place[best]
    return pd.DataFrame({"arm": arm, "ucb": ucb, "pos": pos})


def candidate_scores(log: DataFrame, arms: DataFrame, st: LinUcbState) -> DataFrame:
    """I1/I2/I3 long form: ``t, pos, arm, ucb`` for every candidate.  Events are scored with
    their whole candidate lists, which become rows afterwards."""
    sc = _Scorer(st)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def _u(z: pa.Array, choices: pa.Array) -> pa.Array:
        n = np.asarray(pc.fill_null(pc.list_value_length(choices), 0), dtype=np.int64)
        off = np.concatenate([[0], np.cumsum(n)])
        flat, has = np.asarray(choices.flatten(), dtype=np.int64), np.flatnonzero(n)
        users = matrix(z.take(pa.array(has)))
        out = np.empty(off[-1])
        for k in range(0, len(has), SCORED_EVENTS):
            some = has[k:k + SCORED_EVENTS]
            at = slice(off[some[0]], off[some[-1] + 1])
            out[at] = sc.scores_many(np.repeat(users[k:k + SCORED_EVENTS], n[some], axis=0), flat[at])
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(out))

    e = log.select("t", "choices", _u(F.col("z"), F.col("choices")).alias("ucb"))
    e = e.select("t", F.posexplode(F.arrays_zip("choices", "ucb")).alias("pos", "c"))
    return e.select("t", "pos", F.col("c.choices").alias("arm"), F.col("c.ucb").alias("ucb"))


def ucb_argmax(scores: DataFrame) -> DataFrame:
    """E1 on a long score table: best arm per event, lowest position on ties (no sort)."""
    return scores.groupBy("t").agg(
        F.max_by("arm", F.struct(F.col("ucb"), -F.col("pos"))).alias("picked"))


def argmax_over_choices(choices, score_map) -> F.Column:
    """E1 for a per-arm score map literal: ``struct(ucb, -pos, arm)`` maximum (no shuffle)."""
    cand = F.transform(choices, lambda a, p: F.struct(F.coalesce(F.element_at(score_map, a),
                                                                 F.lit(float("-inf"))).alias("u"),
                                                      (-p).alias("np"), a.alias("arm")))
    return F.array_max(cand)["arm"]


# ------------------------------------------------------------------ replay
def replay_accept(log: DataFrame, picked_col: str = "picked") -> DataFrame:
    """Rows where the policy's pick equals the logged choice."""
    return log.where(F.col(picked_col) == F.col("chosen"))


def replay_ctr(accepted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Reward sum / accepted count; 0.0 when nothing was accepted."""
    by = by or []
    agg = accepted.groupBy(*by).agg(F.count(F.lit(1)).alias("accepted"),
                                   F.sum("reward").cast("bigint").alias("reward_sum"))
    return agg.select(*by, "accepted", F.coalesce("reward_sum", F.lit(0)).alias("reward_sum"),
                      F.when(F.col("accepted") > 0, F.col("reward_sum") / F.col("accepted"))
                      .otherwise(F.lit(0.0)).alias("ctr"))


def replay_frozen(log: DataFrame, st: LinUcbState) -> DataFrame:
    """I4: score a whole log with a frozen model, accept, CTR (pure batch plan)."""
    p = log.withColumn("picked", pick_udf(st)(F.col("z"), F.col("choices"))["arm"])
    acc = replay_accept(p)
    c = replay_ctr(acc)
    return c


def ucb1_scores(log: DataFrame) -> DataFrame:
    """I10 (batch): per arm mean reward + sqrt(2 ln N / n_arm) over the logged rows."""
    per = log.groupBy(F.col("chosen").alias("arm")).agg(F.count(F.lit(1)).alias("n"),
                                                       F.avg("reward").alias("mean"))
    N = log.count()
    return per.withColumn("ucb", F.col("mean") + F.sqrt(F.lit(2.0 * math.log(max(N, 1))) / F.col("n")))


def hoeffding_bound(log: DataFrame, delta: float) -> DataFrame:
    """Per arm sqrt(ln(2/delta) / (2 m)) with m = pulls of the arm."""
    per = log.groupBy(F.col("chosen").alias("arm")).agg(F.count(F.lit(1)).alias("m"),
                                                       F.avg("reward").alias("mean"))
    return per.withColumn("bound", F.sqrt(F.lit(math.log(2.0 / delta)) / (2 * F.col("m"))))


def uniform_policy(log: DataFrame, seed: int) -> DataFrame:
    """Pick choices[md5(seed:t) mod size] (reproducible uniform random policy)."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("t").cast("string"))), 1, 8), 16, 10)
    idx = (h.cast("bigint") % F.size("choices")).cast("int")
    return log.withColumn("picked", F.element_at("choices", idx + 1))


def rejection_sampling(accepted: DataFrame, T_max: int, segment: str = "segment") -> DataFrame:
    """Per segment keep the first T accepted rows in time order (a
    bounded window: only accepted rows of one segment are ordered)."""
    w = Window.partitionBy(segment).orderBy("t")
    return accepted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= T_max).drop("_rn")


def cumulative_regret(log: DataFrame, segment: str = "segment", carry: bool = False) -> DataFrame:
    """Running sum over t of (mu* - mu_chosen) within each segment; mu
    are per-arm mean rewards of the whole log (one row per arm, broadcast
    after a size check).  With ``carry`` the sum runs on over all segments,
    which must follow t: each begins at the total of the smaller ones."""
    mu = log.groupBy(F.col("chosen").alias("arm")).agg(F.avg("reward").alias("mu"))
    if mu.count() > MAX_ARMS:
        raise ValueError("too many arms")
    best = mu.agg(F.max("mu")).first()[0]
    r = log.join(F.broadcast(mu), log.chosen == mu.arm).withColumn("gap", F.lit(best) - F.col("mu"))
    w = Window.partitionBy(segment).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    regret = F.sum("gap").over(w)
    if carry:
        # one row for each segment; their prefix sum is taken over groups of segments, then inside each
        total = r.groupBy(segment).agg(F.sum("gap").alias("_sum")).withColumn("_group", F.floor(F.col(segment) / CARRY))
        before = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        groups = total.groupBy("_group").agg(F.sum("_sum").alias("_sum")).select("_group", before(Window.orderBy("_group")).alias("_far"))
        near = total.select(segment, "_group", before(Window.partitionBy("_group").orderBy(segment)).alias("_near"))
        begin = near.join(groups, "_group").select(segment, (F.col("_far") + F.col("_near")).alias("_begin"))
        r, regret = r.join(begin, segment), regret + F.col("_begin")
    return r.select(segment, "t", "chosen", "gap", regret.alias("regret"))


# ------------------------------------------------------------------ I5 adaptive
class Player:
    """A policy that plays a log event by event: recommend, compare, update on a match.

    ``dump`` gives all it has learned (counts, means, matrices and their running
    inverses) and a player made from that plays on as if it had never stopped.
    """

    def __init__(self, policy: LinUcbPolicy, arm_x: dict, seed: int = 0, learned: bytes | None = None):
        self.policy, self.seed = policy, seed
        self.seen, self.accepted, self.reward = 0, 0, 0
        self.counts: dict = {}
        self.means: dict = {}
        self.scorer = None
        if policy.kind not in ("epsilon_greedy", "ucb1"):
            st = LinUcbState(policy, arm_x)
            _, dz = st.dims()
            if dz:
                st.A0, st.b0 = np.eye(dz), np.zeros(dz)
            self.scorer = _Scorer(st)
        if learned:
            self._load(pickle.loads(learned))

    def _load(self, d: dict) -> None:
        self.seen, self.accepted, self.reward, self.counts, self.means = d["seen"], d["accepted"], d["reward"], d["counts"], d["means"]
        if self.scorer:
            st = self.scorer.st
            st.A, st.b, st.B, st.A0, st.b0 = d["state"]
            for a, i in self.scorer.index.items():
                if a in st.A:
                    self.scorer.Ainv[i], self.scorer.b[i] = d["inverse"][a], st.b[a]
                    if self.scorer.hybrid:
                        self.scorer.B[i] = st.B[a]
            if self.scorer.hybrid:
                self.scorer.A0inv, self.scorer.beta = d["shared"]

    def dump(self) -> bytes:
        d = {"seen": self.seen, "accepted": self.accepted, "reward": self.reward, "counts": self.counts, "means": self.means}
        if self.scorer:
            st = self.scorer.st
            d["state"] = (st.A, st.b, st.B, st.A0, st.b0)
            d["inverse"] = {a: self.scorer.Ainv[self.scorer.index[a]] for a in st.A}
            if self.scorer.hybrid:
                d["shared"] = (self.scorer.A0inv, self.scorer.beta)
        return pickle.dumps(d)

    def _pick(self, t, user: np.ndarray, choices: list[int]) -> int:
        if not choices:
            return -1
        if self.policy.kind == "epsilon_greedy":
            if py_uniform(self.seed, "eps", t) < min(1.0, self.policy.alpha / self.seen):
                return choices[int(py_uniform(self.seed, "epsarm", t) * len(choices))]
            return max(choices, key=lambda a: self.means.get(a, 0.0))       # the first of equal means
        if self.policy.kind == "ucb1":
            log_n, best, pick = 2 * math.log(self.seen), -math.inf, choices[0]
            for a in choices:
                n = self.counts.get(a, 0)
                u = self.means[a] + math.sqrt(log_n / n) if n else math.inf
                if u > best:
                    best, pick = u, a
            return pick
        return self.scorer.pick(user, choices)[0]

    def event(self, t, user, choices, chosen, reward) -> None:
        self.seen += 1
        user = np.asarray(user, dtype=np.float64)
        pick = self._pick(t, user, [int(c) for c in choices])
        if pick != int(chosen):
            return
        self.accepted += 1
        self.reward += int(reward)
        r = float(reward)
        if self.scorer:
            self.scorer.learn(pick, user, -1.0 if self.policy.recodes and r == 0 else r)
        else:
            n = self.counts[pick] = self.counts.get(pick, 0) + 1
            self.means[pick] = self.means.get(pick, 0.0) + (r - self.means.get(pick, 0.0)) / n

    def play(self, rows: pd.DataFrame) -> tuple[int, int]:
        """Rows in order of t; (accepted, reward) of these rows."""
        accepted, reward = self.accepted, self.reward
        rows = rows.sort_values("t", kind="stable")
        if self.scorer and len(rows):
            for s in range(0, len(rows), 4096):
                self._play_blocks(rows.iloc[s:s + 4096])
        else:
            for e in zip(rows["t"], rows["z"], rows["choices"], rows["chosen"], rows["reward"]):
                self.event(*e)
        return self.accepted - accepted, self.reward - reward

    def _play_blocks(self, rows: pd.DataFrame) -> None:
        """The events one after another; as a model only changes with an accepted event, those
        up to the next one are scored together."""
        sc, at, size = self.scorer, 0, 16
        users = np.stack(rows["z"].to_numpy()).astype(np.float64)
        choices, chosen, reward = rows["choices"].to_list(), rows["chosen"].to_numpy(), rows["reward"].to_numpy()
        idx = sc.indices(choices)
        want = sc.places(chosen.astype(np.int64))
        if not sc.hybrid and idx.shape[1]:
            for s in range(0, len(rows), PLAYED_EVENTS):
                one = slice(s, s + PLAYED_EVENTS)
                self._play_block(users[one], idx[one], want[one], chosen[one], reward[one])
            return
        while at < len(rows):
            block = idx[at:at + size]
            pos = sc.pick_block(users[at:at + size], block) if block.shape[1] else np.full(len(block), -1)
            hit = np.flatnonzero((pos >= 0) & (block[np.arange(len(block)), pos] == want[at:at + size])) if block.shape[1] else []
            if not len(hit):
                self.seen += len(block)
                at += len(block)
                size = min(2 * size, 256)
                continue
            k = at + int(hit[0])
            self.seen += k + 1 - at
            self.accepted += 1
            self.reward += int(reward[k])
            r = float(reward[k])
            sc.learn(int(chosen[k]), users[k], -1.0 if self.policy.recodes and r == 0 else r)
            size = max(8, 2 * (k + 1 - at))
            at = k + 1


    def _play_block(self, users, idx, want, chosen, reward) -> None:
        """Events whose candidates are scored once: an accepted event changes only its own
        arm, so only that arm's scores in the later events are taken anew."""
        sc, n, width = self.scorer, len(idx), idx.shape[1]
        scores = np.full(idx.shape, -np.inf)
        pos = sc.pick_block(users, idx, scores)
        hit = (pos >= 0) & (idx[np.arange(n), pos] == want)
        flat = idx.ravel()
        cells = np.argsort(flat, kind="stable")         # the places of an arm, in order of events
        begin = np.searchsorted(flat[cells], np.arange(len(sc.index) + 1))
        self.seen += n
        k = 0
        while k < n:
            k += int(hit[k:].argmax())
            if not hit[k]:
                return
            self.accepted += 1
            self.reward += int(reward[k])
            r, arm = float(reward[k]), want[k]
            sc.learn(int(chosen[k]), users[k], -1.0 if self.policy.recodes and r == 0 else r)
            own = cells[begin[arm]:begin[arm + 1]]
            own = own[np.searchsorted(own, (k + 1) * width):]
            if len(own):
                event = own // width
                scores[event, own % width] = sc._score(users[event], arm)
                best = _best(scores[event])
                hit[event] = (best >= 0) & (idx[event, best] == want[event])
            k += 1


def replay_adaptive(log: DataFrame, arms: DataFrame, policies: list[LinUcbPolicy],
                    segment_len: int, seed: int = 0) -> DataFrame:
    """Sequential replay of each (policy, segment) on its own: a segment is
    ``t div segment_len``, so groups are bounded and run in parallel.  Each segment
    starts from a fresh policy, so the pooled CTR is not the same estimator as one
    pass over the log; that is :func:`tessera.operators.replay.replay_whole`.
    """
    arm_x = arms_dict(arms)
    pids = F.array(*[F.lit(i) for i in range(len(policies))])
    g = log.withColumn("segment", F.floor(F.col("t") / segment_len).cast("bigint")).withColumn("pid", F.explode(pids))

    def _run(pdf: pd.DataFrame) -> pd.DataFrame:
        pid = int(pdf["pid"].iloc[0])
        p = policies[pid]
        acc, rsum = Player(p, arm_x, seed).play(pdf)
        return pd.DataFrame({"pid": [pid], "kind": [p.kind], "alpha": [float(p.alpha)],
                             "segment": [int(pdf["segment"].iloc[0])], "accepted": [acc],
                             "reward_sum": [rsum], "ctr": [rsum / acc if acc else 0.0]})

    # groups differ a lot in cost (hybrid vs UCB1): many small partitions balance them
    return by_key(g, "pid", "segment", factor=8).groupBy("pid", "segment").applyInPandas(
        _run, "pid int, kind string, alpha double, segment bigint, accepted bigint, reward_sum bigint, ctr double")


# ------------------------------------------------------------------ I6 mini-batch
def replay_minibatch(log: DataFrame, arms: DataFrame, policy: LinUcbPolicy, slice_len: int) -> DataFrame:
    """Freeze the model for a slice of ``slice_len`` time units, accept by
    the frozen choice, add the accepted rows' sums (exact), move on.  Choices
    lag by one slice compared with the sequential replay; the statistics of
    a given accepted set are exact.  The log is read once, in lots of slices
    (:func:`tessera.operators.replay.replay_slices`)."""
    from tessera.operators.replay import replay_slices
    return replay_slices(log, arms, policy, slice_len)


class SlicePlayer:
    """Plays slices with a model that is frozen for a slice and then gets its accepted rows' sums."""

    def __init__(self, policy: LinUcbPolicy, arm_x: dict, learned: bytes | None = None):
        self.policy, self.arm_x = policy, arm_x
        self.total: dict = pickle.loads(learned) if learned else {}

    def dump(self) -> bytes:
        return pickle.dumps(self.total)

    def play(self, rows: pd.DataFrame) -> tuple[int, int]:
        """(accepted, reward) of one slice."""
        sc = _Scorer(state_from_arrays(self.total, self.arm_x, self.policy))
        picked = pick_many(sc, rows["z"], rows["choices"])["arm"].to_numpy()
        acc = rows[picked == rows["chosen"].to_numpy()]
        if not len(acc):
            return 0, 0
        reward = acc["reward"].to_numpy(dtype=np.float64)
        r = np.where(reward == 0, -1.0, reward) if self.policy.recodes else reward
        art = np.stack([self.arm_x[int(a)] for a in acc["chosen"]])
        for a, v in row_sums(self.policy.kind, acc["chosen"].to_numpy(dtype=np.int64), r, np.stack(acc["z"].to_numpy()).astype(np.float64), art):
            self.total[a] = self.total[a] + v if a in self.total else v
        return len(acc), int(np.nansum(reward))
