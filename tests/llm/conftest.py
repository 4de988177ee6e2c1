import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows) -> DataFrame with the generic columns, of which two clash with operator names."""

    def make(rows):
        full = [(d, t, "en" if d is not None and d % 2 else None, "s", len(t) if t is not None else None, "x", 7) for d, t in rows]
        return spark.createDataFrame(full, DOCS + ", lang string, source string, n_chars long, sig string, n long").repartition(3)

    return make


@pytest.fixture(scope="session")
def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
