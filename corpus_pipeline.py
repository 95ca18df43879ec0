"""Corpus pipeline: language ID, near-duplicates, decontamination, mixing, token output.

STAGES lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and reread as the
next one's docs.  All but the last return the columns of ``documents``.  Each
works on everything its predecessor kept.  An empty table passes through all
stages.  Rows with a null doc_id are never dropped as duplicates or as
contaminated, because no decision can name them; null texts have no letter and
leave at the first stage.  Of duplicates the smallest doc_id stays, of equal rows
of one id one; texts are read whole, however long.  Columns beyond those of
``documents`` may have any name (also names that a stage uses itself): they go
through every stage under names of their own and come out unchanged.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, language_id, mixing, simhash, token_output
from tessera.llm.common import keep
from tessera.llm.queries import MIX_WEIGHTS, source_domain
from tessera.session import checkpoint_dir, ship_package

#: language ID keeps a text unless the losing side of some decision is this much likelier
REJECT_BELOW = 0.2


#: The columns that stages know by name.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def numbered(docs: DataFrame) -> DataFrame:
    """The table with its further columns numbered."""
    return docs.toDF(*[c if c in KNOWN else f"further_{i}" for i, c in enumerate(docs.columns)])


def own_names(stage):
    """The stage on a table whose further columns are numbered, and its result with their names again."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(spark, numbered(docs), sf_dir).toDF(*docs.columns)
    return run


@own_names
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters go, and texts whose
    machines contradict each other strongly (score under ``REJECT_BELOW``)."""
    ship_package(spark)
    model = language_id.train(docs.where(~language_id.held_out_mod("doc_id", 4, 2)))
    p = language_id.identify(docs, model, keep_cols=tuple(docs.columns))
    return p.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= REJECT_BELOW)).select(*docs.columns)


@own_names
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, of the smallest doc_id.

    An id with several texts stands in the components of all of them: its rows are
    decided one by one, by their fingerprints.
    """
    ship_package(spark)
    groups = keep(simhash.simhash_rows(docs, words=3, radius=2).where("doc_id IS NOT NULL"))
    own = F.col("doc_id") == F.col("component_id")
    rows = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_times"), F.max(own).alias("_own")).where("_own").select("doc_id", "_times")
    named = docs.join(rows, "doc_id")
    once = named.where("_times = 1").select(*docs.columns)
    stay = groups.where(own).groupBy("doc_id", "component").agg(F.min("fp").alias("_fp")).select("doc_id", "_fp")
    # never null, so that no filter on it is inferred: below the join it would fingerprint every text
    again = F.coalesce(simhash.fingerprint_of(F.col("text"), 3), F.lit(0).cast("bigint"))
    more = (named.where("_times > 1").withColumn("_fp", again).join(stay, ["doc_id", "_fp"])
            .dropDuplicates(["doc_id", "_fp"]).select(*docs.columns))
    return once.unionByName(more).unionByName(docs.where("doc_id IS NULL"))


@own_names
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its 5-word shingles)."""
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    bad = decontaminate.contained(docs, items).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


@own_names
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, at target weights; a document of a leaf that is
    short comes once for each epoch in which it is taken."""
    m = mixing.mix(docs, MIX_WEIGHTS, budget_share=1.0, max_epochs=2, exprs={"domain": source_domain()})
    return m.select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids in training order; returns their index."""
    ship_package(spark)
    return token_output.materialize_tokens(numbered(docs), token_output.new_folder(spark))


STAGES = [
    ("language_id", identify_language),
    ("simhash_neardup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]
#: The classifier, the fingerprints' links and the tokeniser have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the hand-over tables lie in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
