"""Bandit queries over the log derived from ``events`` (see sources.testdata)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import bandit as BD
from tessera.operators.replay import replay_whole
from tessera.plans.registry import query, table
from tessera.plans.sqlparts import r6
from tessera.plans.sqlparts import uniform as sql_uniform
from tessera.session import checkpoint_dir
from tessera.sources.lines import arm_lines, bandit_lines, parse_arm_lines, parse_bandit_log, read_lines, write_table
from tessera.sources.testdata import BANDIT_SEED, arms, bandit_log

SEG = 1000
DELTA = 0.05


def _r6(c):
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def _log(spark, sf):
    return bandit_log(table(spark, sf, "events"))


def _arms(spark, sf):
    # model-sized (one row per arm); cached because several small actions read it
    return arms(table(spark, sf, "events")).cache()


def _csum(arr):
    """Position-weighted checksum sum (k+1) * v_k (order-sensitive)."""
    return F.aggregate(F.transform(arr, lambda v, k: v * (k + 1)), F.lit(0.0), lambda a, v: a + v)


S = BANDIT_SEED
LOG = f"""
ev AS (SELECT event_id AS t, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS chosen,
              CASE WHEN value > 100 THEN 1 ELSE 0 END AS reward FROM events),
lg AS (SELECT * FROM ev WHERE chosen IS NOT NULL),
lz AS (SELECT lg.t, lg.chosen, lg.reward, i, {sql_uniform(f"'{S}:user:' || lg.user_id || ':' || i")} AS v
       FROM lg, range(6) r(i)),
arm AS (SELECT DISTINCT chosen AS arm FROM lg),
ax AS (SELECT arm, i, {sql_uniform(f"'{S}:arm:' || arm || ':' || i")} AS v FROM arm, range(6) r(i)),
ch AS (SELECT t, chosen, reward, p::INTEGER AS pos, (chosen // 20) * 20 + p AS arm FROM lg, range(20) r(p)),
half AS (SELECT (min(t) + max(t)) // 2 AS split FROM lg)"""


# ---------------------------------------------------------------- A6
@query("parse_bandit_log", f"""WITH {LOG}
SELECT lg.t, {r6('sum(lz.v)')} AS sum_z, lg.chosen, lg.reward, 20 AS n_choices, (lg.chosen // 20) * 20 AS first_choice
FROM lg JOIN lz USING (t) GROUP BY lg.t, lg.chosen, lg.reward""")
def parse_bandit_log_q(spark, sf):
    """Bandit log lines (time, 6 user floats, chosen, reward, candidates) parsed."""
    p = parse_bandit_log(bandit_lines(_log(spark, sf)))
    return p.select("t", _r6(F.aggregate("z", F.lit(0.0), lambda a, v: a + v)).alias("sum_z"), "chosen",
                    "reward", F.size("choices").alias("n_choices"), F.element_at("choices", 1).alias("first_choice"))


# ---------------------------------------------------------------- C5 / B6 / B7
@query("choices_arms_join", f"""WITH {LOG}
SELECT ch.t, ch.pos, ch.arm, {r6('sum(ax.v)')} AS arm_sum FROM ch JOIN ax USING (arm) GROUP BY ch.t, ch.pos, ch.arm""")
def choices_arms_join(spark, sf):
    """The 20 candidates of every event joined to the arm table (size-checked broadcast)."""
    j = BD.choices_arms_join(_log(spark, sf), _arms(spark, sf))
    return j.select("t", "pos", "arm", _r6(F.aggregate("ax", F.lit(0.0), lambda a, v: a + v)).alias("arm_sum"))


@query("concat_features", f"""WITH {LOG},
cc AS (SELECT t, i AS k, v FROM lz UNION ALL SELECT lg.t, ax.i + 6 AS k, ax.v FROM lg JOIN ax ON ax.arm = lg.chosen)
SELECT t, {r6('sum(v * (k + 1))')} AS checksum, count(*)::INTEGER AS width FROM cc GROUP BY t""")
def concat_features(spark, sf):
    """[user || article] context of the logged arm (position-weighted checksum)."""
    from tessera.functions.features import concat_features as cf
    lg = _log(spark, sf)
    a = _arms(spark, sf)
    j = lg.join(BD.arms_side(a.select(F.col("arm").alias("chosen"), F.col("x").alias("ax"))), "chosen")
    f = j.select("t", cf("z", "ax").alias("f"))
    return f.select("t", _r6(_csum(F.col("f"))).alias("checksum"), F.size("f").alias("width"))


@query("interaction_features", f"""WITH {LOG},
oo AS (SELECT lz.t, lz.i * 6 + ax.i AS k, lz.v * ax.v AS v FROM lz JOIN ax ON ax.arm = lz.chosen)
SELECT t, {r6('sum(v * (k + 1))')} AS checksum, count(*)::INTEGER AS width FROM oo GROUP BY t""")
def interaction_features(spark, sf):
    """Flattened outer(user, article) (36-d) of the logged arm."""
    from tessera.functions.features import interaction_features as inf
    lg = _log(spark, sf)
    a = _arms(spark, sf)
    j = lg.join(BD.arms_side(a.select(F.col("arm").alias("chosen"), F.col("x").alias("ax"))), "chosen")
    f = j.select("t", inf("z", "ax").alias("f"))
    return f.select("t", _r6(_csum(F.col("f"))).alias("checksum"), F.size("f").alias("width"))


# ---------------------------------------------------------------- D11
@query("linucb_stats", f"""WITH {LOG},
aa AS (SELECT a.chosen AS arm, 'A' AS stat, a.i::INTEGER AS i, b.i::INTEGER AS j,
              sum(a.v * b.v) + CASE WHEN a.i = b.i THEN 1.0 ELSE 0.0 END AS v
       FROM lz a JOIN lz b ON a.t = b.t GROUP BY a.chosen, a.i, b.i),
bb AS (SELECT chosen AS arm, 'b' AS stat, i::INTEGER AS i, 0 AS j, sum(reward * v) AS v FROM lz GROUP BY chosen, i)
SELECT arm, stat, i, j, {r6('v')} AS v FROM aa UNION ALL SELECT arm, stat, i, j, {r6('v')} AS v FROM bb""")
def linucb_stats(spark, sf):
    """Per-arm A = I + sum z z^T and b = sum r z over the logged rows (disjoint LinUCB)."""
    lg = _log(spark, sf)
    st = BD.train_state(lg, _arms(spark, sf), BD.LinUcbPolicy("disjoint"))
    return BD.state_long(spark, st).select("arm", "stat", "i", "j", _r6(F.col("v")).alias("v"))


@query("hybrid_linucb_stats")
def hybrid_linucb_stats(spark, sf):
    """Hybrid state (per-arm A, B, b; shared A0, b0 by the telescoped sums), final layout."""
    lg = _log(spark, sf)
    st = BD.train_state(lg, _arms(spark, sf), BD.LinUcbPolicy("hybrid"))
    return BD.state_long(spark, st)


@query("hybrid_linucb_sums", f"""WITH {LOG},
rr AS (SELECT t, chosen AS arm, CASE WHEN reward = 0 THEN -1 ELSE reward END AS r FROM lg),
zz AS (SELECT u.t, u.chosen AS arm, u.i * 6 + a.i AS k, u.v * a.v AS v FROM lz u JOIN ax a ON a.arm = u.chosen),
c AS (
  SELECT a.chosen AS arm, 'xx' AS stat, a.i AS i, b.i AS j, sum(a.v * b.v) AS v FROM lz a JOIN lz b ON a.t = b.t GROUP BY ALL
  UNION ALL SELECT a.chosen, 'rx', a.i, 0, sum(r * a.v) FROM lz a JOIN rr USING (t) GROUP BY a.chosen, a.i
  UNION ALL SELECT a.chosen, 'xz', a.i, z.k, sum(a.v * z.v) FROM lz a JOIN zz z USING (t) GROUP BY a.chosen, a.i, z.k
  UNION ALL SELECT NULL, 'zz', a.k, b.k, sum(a.v * b.v) FROM zz a JOIN zz b ON a.t = b.t GROUP BY a.k, b.k
  UNION ALL SELECT NULL, 'rz', a.k, 0, sum(r * a.v) FROM zz a JOIN rr USING (t) GROUP BY a.k)
SELECT arm, stat, i::INTEGER AS i, j::INTEGER AS j, {r6('v')} AS v FROM c""")
def hybrid_linucb_sums(spark, sf):
    """The sums of the hybrid state (per arm x x^T, x z^T, r x; shared z z^T, r z), final layout."""
    s = BD.linucb_sums(_log(spark, sf), _arms(spark, sf), BD.LinUcbPolicy("hybrid"))
    return s.select("arm", "stat", "i", "j", _r6(F.col("v")).alias("v"))


# ---------------------------------------------------------------- I10 / G9
@query("ucb1_scores", f"""WITH {LOG}
SELECT chosen AS arm, count(*) AS n, {r6('avg(reward)')} AS mean,
       {r6('avg(reward) + sqrt(2.0 * ln((SELECT count(*) FROM lg)) / count(*))')} AS ucb FROM lg GROUP BY chosen""")
def ucb1_scores(spark, sf):
    """UCB1 index per arm over the whole log."""
    s = BD.ucb1_scores(_log(spark, sf))
    return s.select("arm", "n", _r6(F.col("mean")).alias("mean"), _r6(F.col("ucb")).alias("ucb"))


@query("hoeffding_bound", f"""WITH {LOG}
SELECT chosen AS arm, count(*) AS m, {r6('avg(reward)')} AS mean,
       {r6(f'sqrt(ln(2.0 / {DELTA}) / (2 * count(*)))')} AS bound FROM lg GROUP BY chosen""")
def hoeffding_bound(spark, sf):
    """Hoeffding confidence radius per arm (delta = 0.05)."""
    h = BD.hoeffding_bound(_log(spark, sf), DELTA)
    return h.select("arm", "m", _r6(F.col("mean")).alias("mean"), _r6(F.col("bound")).alias("bound"))


# ---------------------------------------------------------------- I4 / B3 / D10 / B4
FROZEN = f"""{LOG},
tr AS (SELECT * FROM lg WHERE t < (SELECT split FROM half)),
sc AS (SELECT chosen AS arm, avg(reward) + sqrt(2.0 * ln((SELECT count(*) FROM tr)) / count(*)) AS ucb
       FROM tr GROUP BY chosen),
evc AS (SELECT ch.t, ch.pos, ch.arm, coalesce(sc.ucb, '-inf'::DOUBLE) AS ucb FROM ch LEFT JOIN sc USING (arm)
        WHERE ch.t >= (SELECT split FROM half)),
pk AS (SELECT t, arm AS picked FROM evc QUALIFY row_number() OVER (PARTITION BY t ORDER BY ucb DESC, pos) = 1),
acc AS (SELECT lg.t, lg.chosen, lg.reward FROM lg JOIN pk USING (t) WHERE pk.picked = lg.chosen)"""


def _frozen_accepted(spark, sf):
    lg = _log(spark, sf)
    lo, hi = lg.agg(F.min("t"), F.max("t")).first()
    split = (lo + hi) // 2
    sc = BD.ucb1_scores(lg.where(F.col("t") < split))
    BD.check_arms(sc)
    m = {int(r["arm"]): float(r["ucb"]) for r in sc.collect()}
    smap = F.create_map(*[x for k, v in sorted(m.items()) for x in (F.lit(k), F.lit(v))])
    ev = lg.where(F.col("t") >= split).withColumn("picked", BD.argmax_over_choices(F.col("choices"), smap))
    return ev, BD.replay_accept(ev)


@query("replay_eval_frozen", f"""WITH {FROZEN}
SELECT count(*) AS accepted, coalesce(sum(reward), 0)::BIGINT AS reward_sum,
       {r6('CASE WHEN count(*) > 0 THEN sum(reward) / count(*) ELSE 0.0 END')} AS ctr FROM acc""")
def replay_eval_frozen(spark, sf):
    """I4: UCB1 frozen on the first half of the log, replayed on the second half."""
    _, acc = _frozen_accepted(spark, sf)
    c = BD.replay_ctr(acc)
    return c.select("accepted", "reward_sum", _r6(F.col("ctr")).alias("ctr"))


@query("replay_accept", f"WITH {FROZEN} SELECT t, chosen, reward FROM acc")
def replay_accept(spark, sf):
    """Log rows whose logged arm equals the frozen policy's pick."""
    _, acc = _frozen_accepted(spark, sf)
    return acc.select("t", "chosen", "reward")


@query("replay_ctr", f"""WITH {FROZEN},
seg AS (SELECT DISTINCT t // {SEG} AS segment FROM lg WHERE t >= (SELECT split FROM half)),
a AS (SELECT t // {SEG} AS segment, count(*) AS accepted, sum(reward) AS rs FROM acc GROUP BY 1)
SELECT seg.segment, coalesce(a.accepted, 0) AS accepted, coalesce(a.rs, 0)::BIGINT AS reward_sum,
       {r6('CASE WHEN coalesce(a.accepted, 0) > 0 THEN a.rs / a.accepted ELSE 0.0 END')} AS ctr
FROM seg LEFT JOIN a USING (segment)""")
def replay_ctr(spark, sf):
    """CTR per segment of the frozen replay; 0.0 where nothing was accepted."""
    ev, acc = _frozen_accepted(spark, sf)
    seg = ev.select(F.floor(F.col("t") / SEG).cast("bigint").alias("segment")).distinct()
    c = BD.replay_ctr(acc.withColumn("segment", F.floor(F.col("t") / SEG).cast("bigint")), ["segment"])
    j = seg.join(c, "segment", "left")
    return j.select("segment", F.coalesce("accepted", F.lit(0)).cast("bigint").alias("accepted"),
                    F.coalesce("reward_sum", F.lit(0)).cast("bigint").alias("reward_sum"),
                    _r6(F.coalesce("ctr", F.lit(0.0))).alias("ctr"))


@query("reward_recode", f"""WITH {LOG}
SELECT t, reward, CASE WHEN reward = 0 THEN -1 ELSE reward END AS recoded FROM lg""")
def reward_recode(spark, sf):
    """Reward 0 -> -1 (final hybrid policy's training signal)."""
    lg = _log(spark, sf)
    return lg.select("t", "reward", BD.reward_recode(F.col("reward")).alias("recoded"))


# ---------------------------------------------------------------- I7 / I11 / E7
UNI = f"""{LOG},
up AS (SELECT t, chosen, reward,
              (chosen // 20) * 20 + (('0x' || substr(md5('{S}:' || t), 1, 8))::BIGINT % 20) AS picked FROM lg)"""


@query("uniform_policy", f"WITH {UNI} SELECT t, picked FROM up")
def uniform_policy(spark, sf):
    """Uniform random policy (md5 of t selects the candidate)."""
    return BD.uniform_policy(_log(spark, sf), S).select("t", "picked")


@query("rejection_sampling", f"""WITH {UNI},
a AS (SELECT t // 2000 AS segment, t, reward FROM up WHERE picked = chosen
      QUALIFY row_number() OVER (PARTITION BY t // 2000 ORDER BY t) <= 20)
SELECT segment, count(*) AS accepted, sum(reward)::BIGINT AS reward_sum,
       {r6('sum(reward) / count(*)')} AS ctr FROM a GROUP BY segment""")
def rejection_sampling(spark, sf):
    """Uniform policy replay, first 20 accepted events per segment of 2000."""
    p = BD.uniform_policy(_log(spark, sf), S).withColumn("segment", F.floor(F.col("t") / 2000).cast("bigint"))
    acc = BD.rejection_sampling(BD.replay_accept(p), 20)
    c = BD.replay_ctr(acc, ["segment"])
    return c.select("segment", "accepted", "reward_sum", _r6(F.col("ctr")).alias("ctr"))


@query("cumulative_regret", f"""WITH {LOG},
mu AS (SELECT chosen, avg(reward) AS mu FROM lg GROUP BY chosen),
g AS (SELECT lg.t, lg.t // {SEG} AS segment, (SELECT max(mu) FROM mu) - mu.mu AS gap FROM lg JOIN mu USING (chosen))
SELECT segment, t, {r6('sum(gap) OVER (PARTITION BY segment ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS regret
FROM g""")
def cumulative_regret(spark, sf):
    """Running regret of the logging policy against the best arm, per segment."""
    lg = _log(spark, sf).withColumn("segment", F.floor(F.col("t") / SEG).cast("bigint"))
    r = BD.cumulative_regret(lg)
    return r.select("segment", "t", _r6(F.col("regret")).alias("regret"))


@query("cumulative_regret_whole_log", f"""WITH {LOG},
mu AS (SELECT chosen, avg(reward) AS mu FROM lg GROUP BY chosen),
g AS (SELECT lg.t, (SELECT max(mu) FROM mu) - mu.mu AS gap FROM lg JOIN mu USING (chosen))
SELECT t, {r6('sum(gap) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS regret FROM g""")
def cumulative_regret_whole_log(spark, sf):
    """Running regret of the logging policy against the best arm, over the whole log."""
    lg = _log(spark, sf).withColumn("segment", F.floor(F.col("t") / SEG).cast("bigint"))
    r = BD.cumulative_regret(lg, carry=True)
    return r.select("t", _r6(F.col("regret")).alias("regret"))


# ---------------------------------------------------------------- R-checked (matrix inverses / sequential)
def _halves(spark, sf, kind):
    """(events of the second half, model learned from the first)."""
    lg = _log(spark, sf)
    lo, hi = lg.agg(F.min("t"), F.max("t")).first()
    split = (lo + hi) // 2
    return lg.where(F.col("t") >= split), BD.train_state(lg.where(F.col("t") < split), _arms(spark, sf), BD.LinUcbPolicy(kind))


def _frozen_linucb(spark, sf, kind):
    ev, st = _halves(spark, sf, kind)
    p = ev.withColumn("p", BD.pick_udf(st)(F.col("z"), F.col("choices")))
    return p.select("t", F.col("p.arm").alias("picked"), F.col("p.pos").alias("pos"),
                    _r6(F.col("p.ucb")).alias("ucb"), "chosen", "reward")


@query("parse_arm_lines", f"""WITH {LOG}
SELECT arm, count(*)::INTEGER AS width, {r6('sum(v * (i + 1))')} AS checksum FROM ax GROUP BY arm""")
def parse_arm_lines_q(spark, sf):
    """Arm lines (id, 6 features) written as text files, every line read back and parsed."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/arms-{uuid.uuid4().hex}"
    p = parse_arm_lines(read_lines(spark, write_table(arm_lines(_arms(spark, sf)), path, kind="text")))
    return p.select("arm", F.size("x").alias("width"), _r6(_csum(F.col("x"))).alias("checksum"))


@query("linucb_scores")
def linucb_scores(spark, sf):
    """Disjoint LinUCB (context = user), frozen on the first half; pick per event."""
    return _frozen_linucb(spark, sf, "disjoint")


@query("linucb_concat_scores")
def linucb_concat_scores(spark, sf):
    """Disjoint LinUCB on [user || article] (12-d)."""
    return _frozen_linucb(spark, sf, "concat")


@query("hybrid_linucb_scores")
def hybrid_linucb_scores(spark, sf):
    """Hybrid LinUCB, final layout (x = user, z = user (x) article)."""
    return _frozen_linucb(spark, sf, "hybrid")


@query("replay_eval_linucb")
def replay_eval_linucb(spark, sf):
    """I4 with LinUCB: frozen hybrid model replayed on the second half; CTR."""
    return BD.replay_frozen(*_halves(spark, sf, "hybrid_concat"))


@query("candidate_scores")
def candidate_scores(spark, sf):
    """I1 long form + E1: UCB of every candidate, argmax by max_by (first position wins ties)."""
    lg = _log(spark, sf)
    a = _arms(spark, sf)
    st = BD.train_state(lg, a, BD.LinUcbPolicy("disjoint"))
    sc = BD.candidate_scores(lg, a, st)
    return BD.ucb_argmax(sc)


POLICIES = [BD.LinUcbPolicy("disjoint", 0.2), BD.LinUcbPolicy("concat", 0.2),
            BD.LinUcbPolicy("hybrid_concat", 0.2), BD.LinUcbPolicy("hybrid", 0.2),
            BD.LinUcbPolicy("ucb1", 0.0), BD.LinUcbPolicy("epsilon_greedy", 1.0)]


@query("replay_eval_adaptive")
def replay_eval_adaptive(spark, sf):
    """Sequential replay per (policy, segment of 2000 events) for four LinUCB layouts, UCB1, eps-greedy."""
    return BD.replay_adaptive(_log(spark, sf), _arms(spark, sf), POLICIES, 2000, S)


@query("replay_eval_whole_log")
def replay_eval_whole_log(spark, sf):
    """The same policies replayed over the whole log, models handed from segment to segment."""
    return replay_whole(_log(spark, sf), _arms(spark, sf), POLICIES, seed=S)


@query("replay_eval_minibatch")
def replay_eval_minibatch(spark, sf):
    """Hybrid LinUCB frozen per slice of 2000 events, exact statistics added per slice."""
    return BD.replay_minibatch(_log(spark, sf), _arms(spark, sf), BD.LinUcbPolicy("hybrid"), 2000)


@query("epsilon_greedy")
def epsilon_greedy(spark, sf):
    """epsilon_t = min(1, c/t) exploration, else the best running mean, over the whole log."""
    return replay_whole(_log(spark, sf), _arms(spark, sf), [BD.LinUcbPolicy("epsilon_greedy", 5.0)], seed=S)
