import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents of the given texts, ids from 0, or of (doc_id, text) pairs."""

    def make(texts, **columns):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, columns.get("lang", "en"), columns.get("source", "s"), None if t is None else len(t)) for i, t in rows], DOCS)

    return make


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
