"""The registered queries of this folder, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op3_simhash_neardup")
def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, at most 2 bits."""
    from tessera.llm.simhash import simhash_groups
    g = simhash_groups(table(spark, sf_dir, "documents"), words=3, radius=2)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    from tessera.llm import language_id as L
    docs = table(spark, sf_dir, "documents")
    held = L.held_out_mod("doc_id", 4, 2)
    model = L.train(docs.where(~held))
    return L.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    from tessera.llm import quality as Q
    from tessera.llm.language_id import held_out_mod
    docs, held = table(spark, sf_dir, "documents"), held_out_mod("doc_id", 5, 0)
    w = Q.train(docs, table(spark, sf_dir, "labels").where(~held))
    return Q.score(docs, w).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP10_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents
  WHERE doc_id IS NOT NULL AND text IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL),
s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
n AS (SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id)
SELECT i.id AS item_id, d.id AS doc_id, CAST(any_value(n.n) AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared,
       count(*) / any_value(n.n) AS containment
FROM s i JOIN s d ON i.kind = 'i' AND d.kind = 'd' AND i.g = d.g JOIN n ON n.id = i.id
GROUP BY i.id, d.id HAVING count(*) >= ceil(0.8 * any_value(n.n) - 1e-9)
"""


@query("op10_decontamination", OP10_SQL)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which documents hold at least 0.8 of the 5-word shingles."""
    from tessera.llm.decontaminate import contained
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


MIX_WEIGHTS = {"domain": {"d0": 0.5, "d1": 0.3, "d2": 0.2}, "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}


def source_domain():
    """Domain of a source in the mixing queries: its number modulo 3 (null without a number)."""
    n = F.regexp_extract("source", r"(\d+)$", 1).try_cast("bigint")
    return F.concat(F.lit("d"), (n % 3).cast("string"))


def _mix_level(parent: str, name: str, above: str, weight: str, budget: str) -> str:
    """One level of the division; ``above`` holds the parents' quotas."""
    group = f"{parent}{name}"
    part = f"PARTITION BY {parent.rstrip(', ')}" if parent else ""
    joined = f"JOIN {above} USING ({parent.rstrip(', ')})" if parent else ""
    return f"""
  SELECT {group}, CASE WHEN sat THEN cap WHEN w > 0 THEN w * (budget - sum(CASE WHEN sat THEN cap ELSE 0 END) OVER ({part}))
           / sum(CASE WHEN sat THEN 0 ELSE w END) OVER ({part}) ELSE 0 END AS q
  FROM (SELECT *, cap / w * rest <= budget - before AS sat FROM (
    SELECT *, coalesce(sum(cap) OVER ({part} ORDER BY cap / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(w) OVER ({part} ORDER BY cap / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM (SELECT {group}, sum(2.0 * tokens)::DOUBLE AS cap, any_value({weight})::DOUBLE AS w FROM leaves GROUP BY {group}) {joined}
    {"" if parent else "CROSS JOIN (SELECT sum(tokens)::DOUBLE * 0.6 AS budget FROM leaves)"}))"""


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS sid, coalesce(CAST(ceil(strlen(text) / 4.0) AS BIGINT), 0) AS tok,
         coalesce('d' || (TRY_CAST(nullif(regexp_extract(source, '(\\d+)$', 1), '') AS BIGINT) % 3), '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source FROM documents),
leaves AS (SELECT domain, lang, source, sum(tok) AS tokens FROM d GROUP BY ALL),
q1 AS (SELECT domain, q AS budget FROM ({_mix_level("", "domain", "", "CASE domain WHEN 'd0' THEN 0.5 WHEN 'd1' THEN 0.3 WHEN 'd2' THEN 0.2 ELSE 1 END", "")})),
q2 AS (SELECT domain, lang, q AS budget FROM ({_mix_level("domain, ", "lang", "q1", "CASE lang WHEN 'en' THEN 0.4 WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 WHEN 'es' THEN 0.2 ELSE 1 END", "")})),
q3 AS (SELECT domain, lang, source, CAST(floor(q) AS BIGINT) AS quota FROM ({_mix_level("domain, lang, ", "source", "q2", "1", "")})),
p AS (SELECT domain, lang, source, quota // tokens AS whole, quota % tokens AS rest FROM leaves JOIN q3 USING (domain, lang, source)
      WHERE quota > 0 AND tokens > 0),
k AS (SELECT *, CAST('0x' || substr(md5('17:' || whole || ':' || sid), 1, 15) AS BIGINT) AS key FROM d JOIN p USING (domain, lang, source)),
c AS (SELECT *, sum(tok) OVER (PARTITION BY domain, lang, source ORDER BY key, sid)
           - sum(tok) OVER (PARTITION BY domain, lang, source, key, sid) AS start FROM k)
SELECT doc_id, domain, lang, source, CAST(unnest(range(0, CAST(whole + CAST(start < rest AS BIGINT) AS BIGINT))) AS BIGINT) AS epoch, tok AS tokens FROM c
"""


@query("op7_mixing", OP7_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen for 0.6 of all tokens at target weights, at most two epochs of a leaf."""
    from tessera.llm.mixing import NONE, mix
    d = table(spark, sf_dir, "documents").withColumn("domain", source_domain())
    m = mix(d, MIX_WEIGHTS, budget_share=0.6, max_epochs=2)
    level = lambda c: F.coalesce(F.col(c), F.lit(NONE)).alias(c)
    return m.select("doc_id", level("domain"), level("lang"), level("source"),
                    F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("tokens"))


@query("op2_token_output")
def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the shards with all documents' token ids in training order."""
    from tessera.llm.token_output import materialize_tokens, new_folder
    return materialize_tokens(table(spark, sf_dir, "documents"), new_folder(spark))


@query("op1_embedding_neardup")
def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.95 between all embeddings and their components."""
    from tessera.llm.embedding_dedup import linked_vectors
    return linked_vectors(table(spark, sf_dir, "embeddings"))


OP6_SQL = r"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
           FROM documents WHERE text IS NOT NULL),
bad AS (SELECT trim(line, ' ') AS k FROM l WHERE strlen(trim(line, ' ')) >= 20 GROUP BY 1 HAVING count(DISTINCT source) >= 10),
d AS (SELECT doc_id, count(*) AS n_lines, count(bad.k) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.k IS NULL), '') AS kept
      FROM l LEFT JOIN bad ON trim(line, ' ') = bad.k GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, sha256(kept) AS kept_sha256
FROM documents LEFT JOIN d USING (doc_id)
"""


@query("op6_line_dedup", OP6_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur at ten or more sources."""
    from tessera.llm.line_dedup import remove_boilerplate
    r = remove_boilerplate(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_EVERY_SQL = r"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
           FROM documents WHERE text IS NOT NULL),
bad AS (SELECT trim(line, ' ') AS k FROM l WHERE regexp_matches(line, '\S') GROUP BY 1 HAVING count(DISTINCT source) >= 10),
d AS (SELECT doc_id, count(*) AS n_lines, count(bad.k) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.k IS NULL), '') AS kept
      FROM l LEFT JOIN bad ON trim(line, ' ') = bad.k GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, sha256(kept) AS kept_sha256
FROM documents LEFT JOIN d USING (doc_id)
"""


@query("op6_line_dedup_every_line", OP6_EVERY_SQL)
def op6_line_dedup_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without any non-blank line that occurs at ten or more sources, however short."""
    from tessera.llm.line_dedup import remove_boilerplate
    r = remove_boilerplate(table(spark, sf_dir, "documents"), least_bytes=1)
    return r.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that 50-byte strings of smaller doc_ids cover, removed."""
    from tessera.llm.suffix_dedup import remove_repeats
    r = remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return r.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_paragraph_dedup")
def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that stay in a smaller doc_id: bytes and runs to remove."""
    from tessera.llm.paragraph_dedup import repeated_passages
    r = repeated_passages(table(spark, sf_dir, "documents"), whole=True)
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return r.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_in")
