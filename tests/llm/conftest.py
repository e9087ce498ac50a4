import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a table of documents, with a column too many, from (doc_id, text) pairs."""

    def build(rows):
        rows = [(i, t, "en", "s", len(t or ""), "node") for i, t in rows]
        return spark.createDataFrame(rows, DOCUMENTS + ", node string").repartition(3)

    return build
