"""Small tables of documents for the operators on training data."""

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A function from texts, or (id, text[, lang[, source]]) tuples, to a table."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            row = (*row, *["en", "a"][len(row) - 2 :]) if len(row) < 4 else row
            full.append((*row, None if row[1] is None else len(row[1])))
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
