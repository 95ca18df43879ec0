"""Compare a Spark query with its DuckDB oracle (row multiset, columns by name)."""

from __future__ import annotations

import collections
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return str(v)


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> dict:
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, b = multiset(df.columns, srows), multiset(dcols, drows)
    return {"rows": len(srows), "oracle_rows": len(drows), "cols_match": sorted(df.columns) == sorted(dcols),
            "match": sorted(df.columns) == sorted(dcols) and a == b,
            "only_spark": list((a - b).elements())[:3], "only_oracle": list((b - a).elements())[:3]}
