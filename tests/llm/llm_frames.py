import pytest


@pytest.fixture
def frame(spark):
    """A table like documents, with null and odd rows and columns that clash with the operators' own."""

    def make(texts, ids=None, lang=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, lang, "s", "x", 7, "k") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id string, n long, key string")

    return make
