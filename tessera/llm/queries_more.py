"""Registered queries of HTML extraction, fill-in-middle and conversation repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.queries import query, table

OP12_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and arranged for filling in its middle, and restored from that output."""
    from tessera.llm.fill_in_middle import arrange, restore
    keep = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return restore(arrange(table(spark, sf_dir, "documents")), keep_cols=keep).select(*keep, "restored_sha256")


@query("op11_html_extraction")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from tessera.llm.html_extract import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults, its cheapest edits and the hash of what they leave."""
    from tessera.llm.conversation_repair import damage, repair
    return repair(damage(table(spark, sf_dir, "conversations")), gone_col="gone")
