import pytest
from pyspark.sql import types as T

from riskloom.llm.queries import reach_workers

DOCUMENT = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("text", T.StringType())
    .add("lang", T.StringType())
    .add("source", T.StringType())
    .add("n_chars", T.LongType())
)


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]) tuples."""

    def make(*rows):
        full = [(*row, *(None,) * (4 - len(row)))[:4] for row in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCUMENT)

    return make


def without_ids(rows):
    return sorted(map(repr, rows))
