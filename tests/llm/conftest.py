import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) as a documents table with clashing extra columns."""
    def make(rows, schema="doc_id bigint, text string"):
        df = spark.createDataFrame(rows, schema)
        for c in ("fp", "component", "key", "count", "n", "s", "node"):
            if c not in df.columns:
                df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make
