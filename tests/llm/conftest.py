import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, source) or texts, with all columns."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, "s")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make
