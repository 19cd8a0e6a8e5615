import pytest
from pyspark.sql import Row

from payfeed.llm.files import reach_workers


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with results."""

    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long, length string, ranges string, text_key string"
        return spark.createDataFrame([Row(i, t, extra.get("lang"), "s", len(t or ""), "x", "y", "z") for i, t in rows], schema)

    return make
