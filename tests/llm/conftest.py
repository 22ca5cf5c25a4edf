import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents table from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOC_SCHEMA)
    return make
