import pytest


@pytest.fixture(scope="module")
def docs_of(spark):
    """Documents from texts, ids counted from 1, with columns of clashing names."""

    def make(*texts, ids=None):
        rows = [(i, t, "x", "y") for i, t in zip(ids or range(1, len(texts) + 1), texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, found string, key string")

    return make
