import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("key", T.StringType()), T.StructField("leaf", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, lang]) as documents with extra columns whose names operators use inside."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), 7, "k", "l") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
