"""Reusable DuckDB SQL fragments for the oracles (independent of the Spark code).

They restate the fixed rules in SQL: tokenisation, 60-bit shingle ids,
md5-derived hash coefficients and uniforms.
"""

from __future__ import annotations

MASK64 = "18446744073709551615::HUGEINT"


def hexint(expr: str, digits: int) -> str:
    return f"('0x' || substr(md5({expr}), 1, {digits}))::BIGINT"


def uniform(key_expr: str) -> str:
    """U(0,1) from md5 of a string key (52 bits)."""
    return f"((({hexint(key_expr, 13)})::DOUBLE + 0.5) / 4503599627370496.0)"


def gaussian(key_expr: str) -> str:
    u1 = uniform(f"{key_expr} || ':g1'")
    u2 = uniform(f"{key_expr} || ':g2'")
    return f"(sqrt(-2.0 * ln({u1})) * cos(2 * pi() * {u2}))"


def r6(expr: str) -> str:
    return f"(round(({expr})::DOUBLE, 6) + 0.0)"


def shingles_cte(k: int = 3, table: str = "documents", id_col: str = "doc_id",
                 text_col: str = "text", name: str = "sh") -> str:
    """CTE ``name(doc_id, s)``: distinct k-shingle ids of each text with a word."""
    return f"""
{name}_w AS (
  SELECT {id_col} AS doc_id,
         list_filter(string_split_regex(lower({text_col}), '\\s+'), lambda x: x <> '') AS w
  FROM {table} WHERE {text_col} IS NOT NULL),
{name} AS (
  SELECT doc_id,
         list_distinct(list_transform(range(0, greatest(1, len(w) - {k - 1})),
             lambda i: {hexint(f"array_to_string(w[i + 1:i + {k}], ' ')", 15)})) AS s
  FROM {name}_w WHERE len(w) > 0)"""


def coef_cte(n: int, seed: int, tag: str, name: str) -> str:
    """CTE ``name(h, a, b)`` of multiply-add hash coefficients."""
    return f"""
{name} AS (
  SELECT i AS h,
         2 * {hexint(f"'{seed}:{tag}:a:' || i", 15)}::HUGEINT + 1 AS a,
         {hexint(f"'{seed}:{tag}:b:' || i", 15)}::HUGEINT AS b
  FROM range({n}) t(i))"""


def minhash_ctes(n: int, seed: int, sets: str = "sh", name: str = "sig") -> str:
    """CTE ``name(doc_id, h, v)``: v = min over set of ((a_h x + b_h) mod 2^64) >> 3."""
    return f"""{coef_cte(n, seed, 'mh', name + '_c')},
{name}_x AS (SELECT doc_id, unnest(s) AS x FROM {sets}),
{name} AS (
  SELECT doc_id, h, (min((a * x + b) & {MASK64}) >> 3)::BIGINT AS v
  FROM {name}_x, {name}_c GROUP BY doc_id, h)"""


def band_ctes(r: int, b: int, seed: int, sig: str = "sig", name: str = "bnd") -> str:
    """CTE ``name(doc_id, band, key)`` from a long signature table."""
    joined = "string_agg(g.v::VARCHAR, ',' ORDER BY g.h)"
    return f"""
{name} AS (
  SELECT g.doc_id, (g.h // {r})::INTEGER AS band, {hexint(joined, 15)} AS key
  FROM {sig} g GROUP BY g.doc_id, g.h // {r})"""


def groups_ctes(sets: str = "sh", name: str = "grp") -> str:
    """CTEs ``name(doc_id, rep)`` (identical sets) and ``name_reps(doc_id, s)``."""
    return f"""
{name}_k AS (SELECT doc_id, s, md5(array_to_string(list_sort(s), ',')) AS k FROM {sets} WHERE len(s) > 0),
{name}_m AS (SELECT k, min(doc_id) AS rep FROM {name}_k GROUP BY k),
{name} AS (SELECT d.doc_id, m.rep FROM {name}_k d JOIN {name}_m m USING (k)),
{name}_reps AS (SELECT d.doc_id, d.s FROM {name}_k d JOIN {name}_m m ON d.k = m.k AND d.doc_id = m.rep)"""


def exact_pairs_ctes(threshold: float, sets: str = "grp_reps", name: str = "ex") -> str:
    """CTE ``name(doc_a, doc_b, j)``: all pairs of sets with Jaccard >= t (inverted index)."""
    return f"""
{name}_inv AS (SELECT doc_id, unnest(s) AS e FROM {sets}),
{name}_n AS (SELECT doc_id, len(s) AS n FROM {sets}),
{name}_i AS (
  SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS i
  FROM {name}_inv a JOIN {name}_inv b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY 1, 2),
{name} AS (
  SELECT doc_a, doc_b, i / (na.n + nb.n - i) AS j
  FROM {name}_i JOIN {name}_n na ON na.doc_id = doc_a JOIN {name}_n nb ON nb.doc_id = doc_b
  WHERE i / (na.n + nb.n - i) >= {threshold})"""


def near_dup_edges_ctes(threshold: float, k: int = 3, table: str = "documents",
                        id_col: str = "doc_id", text_col: str = "text", name: str = "nd") -> str:
    """CTE ``name(doc_a, doc_b, j)``: the compressed near-duplicate edge list."""
    return f"""{shingles_cte(k, table, id_col, text_col)},{groups_ctes()},{exact_pairs_ctes(threshold)},
{name} AS (
  SELECT doc_a, doc_b, j FROM ex
  UNION ALL
  SELECT rep AS doc_a, doc_id AS doc_b, 1.0 AS j FROM grp WHERE doc_id <> rep)"""
