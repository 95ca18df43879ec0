"""Cross-site boilerplate lines by distinct-site spread.

A line that occurs on at least ``sites`` different sites is boilerplate and is
removed wherever it stands.  The spread of every line hash is estimated by a
HyperLogLog sketch that merges by aggregation, so a line of any frequency costs
one sketch for each task that meets it.  Estimates outside the sketch's error
band decide by themselves; the lines inside the band get exact distinct counts.

Only DataFrame functions.  A line is hashed to two 64-bit values of its trimmed
text; blank lines and lines under ``least_bytes`` are never boilerplate; with
``least_bytes=1`` every other line is judged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep

SITES = 10
LEAST_BYTES = 20
#: registers of a sketch, as a power of 2
LG_K = 10
#: half the width of the band in which sites are counted exactly, as a share of ``sites``:
#: four standard errors of a sketch of 2^LG_K registers
BAND = 4 * 1.04 / 2 ** (LG_K / 2)


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str, least_bytes: int) -> DataFrame:
    """``doc_id, site, at, h1, h2``: one row for each line that may be boilerplate."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(site_col).cast("string").alias("site"),
                    F.posexplode_outer(F.split(F.col(text_col), "\n")).alias("at", "line"))
    line = F.trim(F.col("line"))
    return (d.where((F.octet_length(line) >= least_bytes) & line.rlike(r"\S"))
            .select("doc_id", "site", "at", F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2")))


def spread_of_lines(rows: DataFrame, sites: int = SITES) -> DataFrame:
    """``h1, h2, n_sites`` of the boilerplate lines of ``h1, h2, site``; null sites are no site.

    ``n_sites`` is the sketch's estimate, exact for lines near the threshold.
    """
    est = (rows.where("site IS NOT NULL").groupBy("h1", "h2")
           .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("est")))
    est = keep(est.where(F.col("est") >= sites * (1 - BAND)))
    sure = est.where(F.col("est") > sites * (1 + BAND)).select("h1", "h2", F.col("est").cast("bigint").alias("n_sites"))
    near = est.where(F.col("est") <= sites * (1 + BAND)).select("h1", "h2")
    # (line, site) pairs are made distinct before the join, so a frequent line has a row for each site
    exact = (rows.where("site IS NOT NULL").select("h1", "h2", "site").distinct().join(near, ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_sites")).where(F.col("n_sites") >= sites))
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, sites: int = SITES, least_bytes: int = LEAST_BYTES, id_col: str = "doc_id",
                       text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_text`` of every row of ``docs``.

    A null text stays null with 0 lines; a document whose lines all go keeps an
    empty text.  Rows with a null id count for the spread; they, and repeated
    rows of an id, lose the lines that the documents of their id lose.  An
    empty table gives an empty result.
    """
    rows = line_rows(docs, id_col, text_col, site_col, least_bytes)
    bad = spread_of_lines(rows.select("h1", "h2", "site"), sites).select("h1", "h2")
    # grouped by document only, so that the join may split a frequent line
    gone = (rows.join(bad, ["h1", "h2"], "left_semi")
            .groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("bad")))  # lines of one document
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    j = d.join(gone, d["doc_id"].eqNullSafe(gone["doc_id"]), "left").select(d["doc_id"], "_text", "bad")
    lines = F.split("_text", "\n")
    line_key = lambda x: F.struct(F.xxhash64(F.trim(x)).alias("h1"), F.xxhash64(F.trim(x), F.lit(1)).alias("h2"))
    kept = F.filter(lines, lambda x: (F.octet_length(F.trim(x)) < least_bytes) | ~F.array_contains("bad", line_key(x)))
    j = j.withColumn("_kept", F.when(F.col("bad").isNull(), lines).otherwise(kept))
    return j.select("doc_id", F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
                    F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines) - F.size("_kept")).alias("n_removed"),
                    F.array_join("_kept", "\n").alias("kept_text"))
