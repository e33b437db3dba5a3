import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    def docs(rows):
        full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return docs
