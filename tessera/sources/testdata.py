"""Inputs in the reference's shapes, built from the test tables.

These only give rows in the schema a job expects; they do none of the
job's work.

Bandit log from ``events`` (fixed mapping):
  t       = event_id (log order)
  arm     = the integer ``k`` in ``props`` ({"k": 0..99})
  chosen  = arm; reward = 1 if value > 100 else 0
  choices = the 20 arms a with a div 20 = k div 20 (list order ascending)
  z       = 6 user features, uniform(seed:user:user_id:i), i = 0..5
Arms: every distinct k, x = 6 features uniform(seed:arm:k:i).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform

BANDIT_SEED = 3
D_USER = 6
D_ARM = 6
N_CHOICES = 20


def _arm(events: DataFrame):
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def bandit_log(events: DataFrame, seed: int = BANDIT_SEED, keep: list[str] | None = None) -> DataFrame:
    """``keep`` carries extra input columns (e.g. event time for streaming)."""
    k = _arm(events)
    lo = F.floor(k / N_CHOICES) * N_CHOICES
    return events.select(*(keep or []),
        F.col("event_id").alias("t"),
        F.array(*[uniform(seed, "user", F.col("user_id"), i) for i in range(D_USER)]).alias("z"),
        k.alias("chosen"),
        F.when(F.col("value") > 100, 1).otherwise(0).alias("reward"),
        F.sequence(lo.cast("bigint"), (lo + N_CHOICES - 1).cast("bigint")).alias("choices"),
    ).where(F.col("chosen").isNotNull())


def arms(events: DataFrame, seed: int = BANDIT_SEED) -> DataFrame:
    k = _arm(events).alias("arm")
    a = events.select(k).where(F.col("arm").isNotNull()).distinct()
    return a.select("arm", F.array(*[uniform(seed, "arm", F.col("arm"), i) for i in range(D_ARM)]).alias("x"))
