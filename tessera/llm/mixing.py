"""Mixing sources to target weights by hierarchical budgeting.

The token budget flows down a tree (domain, language, source).  At each node it
is divided among the children by their weights; a child that cannot take its
share (its texts times ``max_epochs``) passes the shortage to its siblings, by
weight, and only what a whole subtree cannot take reaches the siblings of its
ancestors.  This division is a closed form over windows as large as a node has
children.  A leaf with quota a and t tokens takes floor(a / t) whole epochs and,
of one more epoch, the shortest prefix in seeded order whose tokens reach the
rest.  The prefix is found without sorting a leaf in one task: tokens are summed
in about sqrt(documents) key ranges, and only the range in which the prefix ends
is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import keep

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
#: leaves up to which the decisions are broadcast to the documents
LEAF_ROWS = 100_000


def token_count(text: Column) -> Column:
    """Token estimate that needs no tokeniser: a quarter of the UTF-8 bytes, rounded up; 0 for null."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("bigint")


def order_key(seed: int, epoch: Column, id_text: Column) -> Column:
    """60-bit position of a document in the order of an epoch."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_text))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def _weight(level: Column, table: dict | None, default: float) -> Column:
    if not table:
        return F.lit(default)
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(float(v)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), level), F.lit(default))


def divide(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``quota`` to rows ``parents, name, cap, w, budget``: water-filling within each parent."""
    ratio = F.when(F.col("w") > 0, F.col("cap") / F.col("w"))
    by = Window.partitionBy(*parents, F.lit(0))
    order = by.orderBy(F.col("_r").asc_nulls_last(), name)
    d = children.withColumn("_r", ratio).withColumn("_w", F.when(F.col("_r").isNotNull(), F.col("w")).otherwise(0.0))
    d = d.withColumn("_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    d = d.withColumn("_rest", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    full = F.col("_r").isNotNull() & (F.col("_r") * F.col("_rest") <= F.col("budget") - F.col("_before"))
    d = d.withColumn("_full", full)
    spent = F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0.0)).over(by)
    open_w = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(by)
    d = d.withColumn("_spent", spent).withColumn("_open", open_w)
    quota = F.when(F.col("_full"), F.col("cap")).when(F.col("_w") > 0, F.col("_w") * (F.col("budget") - F.col("_spent")) / F.col("_open")).otherwise(0.0)
    return d.withColumn("quota", quota).drop("_r", "_w", "_before", "_rest", "_full", "_spent", "_open")


def allocate(leaves: DataFrame, levels: tuple = LEVELS, weights: dict | None = None, budget: float = 0.0,
             max_epochs: int = 2, default: float = 1.0) -> DataFrame:
    """``levels, tokens, docs`` -> the same and ``quota`` (whole tokens)."""
    weights = weights or {}
    leaves = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    above = None
    for k, name in enumerate(levels):
        path = list(levels[:k + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("w", _weight(F.col(name), weights.get(name), default))
        nodes = (nodes.withColumn("budget", F.lit(float(budget))) if above is None
                 else nodes.join(above, path[:-1]))
        above = divide(nodes, path[:-1], name).select(*path, F.col("quota").alias("budget"))
    return leaves.drop("cap").join(above, list(levels)).withColumn("quota", F.floor("budget").cast("bigint")).drop("budget")


def mix(docs: DataFrame, weights: dict | None = None, budget_share: float = 1.0, max_epochs: int = 2, seed: int = 17,
        levels: tuple = LEVELS, exprs: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, once for each epoch in which they are chosen, with
    ``mix_epoch`` and ``mix_tokens`` (own columns of these names are replaced).

    The budget is ``budget_share`` of all tokens.  ``exprs`` gives a level that
    is no column of its own.  A null in a level is the branch ``(none)``;
    branches of weight 0 and leaves without tokens get nothing; texts without
    tokens ride along in whole epochs, or before the end of a prefix.  Repeated
    rows of one id stand together in the order; null ids stand together as one.
    Very long texts count by their bytes like any other.  Other columns may have any
    name.  An empty table gives an empty result.
    """
    kept = [(f"_own{i}", c) for i, c in enumerate(docs.columns) if c not in ("mix_epoch", "mix_tokens")]
    own = [name for name, _ in kept]                     # whatever the columns are called, no name below meets theirs
    at = {x: f"_mix_{x}" for x in levels}
    d = docs.select(*[F.col(f"`{c}`").alias(name) for name, c in kept], token_count(F.col(text_col)).alias("mix_tokens"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_mix_id"),
                    *[F.coalesce((exprs or {}).get(x, F.col(x)).cast("string"), F.lit(NONE)).alias(at[x]) for x in levels])
    path = list(at.values())
    narrow = d.select(*path, "_mix_id", "mix_tokens")
    leaves = keep(narrow.groupBy(*path).agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    by_path = {at[x]: t for x, t in (weights or {}).items()}
    plan = keep(allocate(leaves, tuple(path), by_path, float(total) * budget_share, max_epochs)
                .where("quota > 0 AND tokens > 0")
                .withColumn("full", F.expr("quota div tokens")).withColumn("rest", F.expr("quota % tokens"))
                .withColumn("ranges", F.ceil(F.sqrt("docs")).cast("bigint"))
                .select(*path, "full", "rest", "ranges"))
    few = plan.count() <= LEAF_ROWS
    side = (lambda x: F.broadcast(x)) if few else (lambda x: x)
    key = order_key(seed, F.col("full"), F.col("_mix_id"))
    width = F.lit(float(1 << 60))
    keyed = (narrow.join(side(plan.where("rest > 0")), path).withColumn("key", key)
             .withColumn("range", F.least(F.floor(F.col("key") / width * F.col("ranges")), F.col("ranges") - 1)))
    sums = keyed.groupBy(*path, "rest", "range").agg(F.sum("mix_tokens").alias("s"))
    upto = F.sum("s").over(Window.partitionBy(*path).orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    last = (sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("s"))
            .where("before < rest AND rest <= upto").select(*path, "range", "before"))
    inside = keyed.join(last, [*path, "range"])
    order = Window.partitionBy(*path).orderBy("key", "_mix_id")  # peers count together
    peers = Window.partitionBy(*path, "key", "_mix_id")
    starts = inside.withColumn("b", F.col("before") + F.sum("mix_tokens").over(order) - F.sum("mix_tokens").over(peers))
    cut = starts.where("b < rest").groupBy(*path).agg(F.max(F.struct("key", "_mix_id")).alias("cut"))
    decide = side(plan.join(cut, path, "left").select(*path, "full", "cut"))
    j = d.join(decide, path).withColumn("_key", F.struct(key.alias("key"), F.col("_mix_id").alias("_mix_id")))
    copies = F.col("full") + F.coalesce((F.col("_key") <= F.col("cut")).cast("bigint"), F.lit(0))
    return (j.withColumn("_n", copies).where("_n > 0")
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
            .select(*[F.col(name).alias(c) for name, c in kept], "mix_epoch", "mix_tokens"))
