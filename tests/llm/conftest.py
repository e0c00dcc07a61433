import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from texts, with an extra column whose name operators use themselves."""

    def build(texts, ids=None, parts=3):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts)]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return build
