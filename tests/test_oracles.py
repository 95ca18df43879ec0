"""Every query with an oracle matches DuckDB on sf0.001 (the driver checks sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con0001, name):
    from tessera.plans.check import compare
    r = compare(QUERIES[name](spark, SF0001), con0001, ORACLES[name])
    assert r["cols_match"], r
    assert r["match"], r


def test_mutated_oracle_fails(spark, con0001):
    """The comparison can fail: a changed threshold in the SQL is detected."""
    from tessera.plans.check import compare
    sql = ORACLES["margin_violators"].replace("y * score * 100 < 1", "y * score * 100 < 0.5")
    assert sql != ORACLES["margin_violators"]
    r = compare(QUERIES["margin_violators"](spark, SF0001), con0001, sql)
    assert not r["match"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_a", "doc_b", "jaccard"]
    rows = df.collect()
    assert rows and all(r.doc_a < r.doc_b and 0.85 <= r.jaccard <= 1 for r in rows)
