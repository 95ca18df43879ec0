"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document if at least ``threshold`` of the item's
distinct word shingles occur in it.  Items are short and documents long, so the
search does not compare signatures of equal shape (the similarity of an item to
a long document is almost 0).  An item is represented by its MinHash sketch, its
shingles with the smallest hash values, and a document by the shingles it has.
An item of n shingles may lack m = n - ceil(threshold * n) of them, so a sketch
of m + h shingles has at least h hits in every document that contains the item:
the search loses nothing.  Documents are partitioned by size: an item is only
searched in size classes that can hold it, and longer documents, where chance
hits are likelier, must have more hits (``HITS``).  Candidates are verified by
exact shingle containment.

Only DataFrame functions; shingles are 64-bit hashes of five 64-bit word hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep

WORDS = 5
THRESHOLD = 0.8
#: (documents of up to this many shingles, sketch hits asked for)
HITS = ((256, 1), (2048, 2), (None, 3))
#: sketch rows (24 bytes each) up to which the sketch table is broadcast
SKETCH_ROWS = 1_000_000


def shingles(df: DataFrame, text: str, words: int = WORDS, out: str = "_s") -> DataFrame:
    """Adds ``out``: hashes of all word shingles in order (not distinct).

    Words are the runs of non-blank characters of the lower-cased text; a text
    with fewer words has one shingle of all of them, one without words or null
    has none.
    """
    w = F.filter(F.split(F.lower(F.col(text)), r"[ \t-\r]+"), lambda x: x != "")
    df = df.withColumn("_w", F.transform(F.coalesce(w, F.array().cast("array<string>")), lambda x: F.xxhash64(x)))
    n = F.size("_w")
    rolled = F.transform(F.sequence(F.lit(1), n - (words - 1)),
                         lambda i: F.xxhash64(*[F.element_at("_w", i + F.lit(k)) for k in range(words)]))
    short = F.array(F.xxhash64(F.lit("short"), F.array_join(F.col("_w").cast("array<string>"), " ")))
    return df.withColumn(out, F.when(n >= words, rolled).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))).drop("_w")


def _needed(n: Column, threshold: float) -> Column:
    """Shingles of n that must occur."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def item_sets(items: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``item_id, own`` (distinct shingle hashes): rows of one item id are united; null ids and empty items are left out."""
    rows = shingles(items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("_t")), "_t", words)
    one = rows.select("item_id", F.explode_outer("_s").alias("s")).where("s IS NOT NULL").distinct()
    return one.groupBy("item_id").agg(F.collect_list("s").alias("own"))  # as long as one test item


def sketches(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, n, rank, s``: the m + h smallest shingles of each item by a hash of the shingle."""
    n = F.size("own")
    ranked = F.array_sort(F.transform("own", lambda s: F.struct(F.xxhash64(s, F.lit("rank")).alias("r"), s.alias("s"))))
    size = n - _needed(n, threshold) + max(h for _, h in HITS)
    return (sets.select("item_id", n.alias("n"), F.posexplode_outer(F.slice(ranked, 1, size)))
            .select("item_id", "n", F.col("pos").alias("rank"), F.col("col.s").alias("s")))


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
              id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, doc_id, n_item, n_shared, containment`` of all pairs at or above the threshold.

    Rows with a null document or item id take no part.  Of several rows with
    one doc_id the best counts.  Texts under ``words`` words match only items of
    just the same words.  Empty tables give an empty result.
    """
    sets = keep(item_sets(items, item_id, item_text, words))
    sk = keep(sketches(sets, threshold))
    n_sk = sk.count()
    probe = sk.select(F.col("s").alias("p"), "item_id", "n", "rank")
    if n_sk <= SKETCH_ROWS:
        probe = F.broadcast(probe)  # counted: at most SKETCH_ROWS rows
    d = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    # explode_outer: for explode the optimizer infers a filter on the array's size and
    # pushes it below the projection, where it would run the tokeniser for every shingle
    rows = shingles(d, "_t", words).select("doc_id", F.size("_s").alias("m"), F.explode_outer("_s").alias("p"))
    hits = rows.join(probe, "p")
    ask = F.lit(HITS[-1][1])
    for most, h in reversed(HITS[:-1]):
        ask = F.when(F.col("m") <= most, h).otherwise(ask)
    need, spare = _needed(F.col("n"), threshold), F.col("n") - _needed(F.col("n"), threshold)
    least = F.least(ask, need)
    # m counts repeats, so it bounds the distinct shingles of the document from above
    fits = (F.col("m") >= need) & (F.col("rank") < spare + least)
    cand = (hits.where(fits).select("doc_id", "m", "item_id", "rank", least.alias("least")).distinct()
            .groupBy("doc_id", "m", "item_id", "least").count().where(F.col("count") >= F.col("least"))
            .select("doc_id", "item_id").distinct())
    cand = keep(cand)
    wanted = d.join(cand.select("doc_id").distinct(), "doc_id", "left_semi")
    pairs = shingles(wanted, "_t", words).join(cand, "doc_id").join(sets, "item_id")
    shared = F.size(F.array_intersect("own", "_s"))
    n = F.size("own")
    return (pairs.select("item_id", "doc_id", n.alias("n_item"), shared.alias("n_shared"))
            .where(F.col("n_shared") >= _needed(F.col("n_item"), threshold))
            .groupBy("item_id", "doc_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item")))
