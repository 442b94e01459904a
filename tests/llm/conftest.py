import pytest
from pyspark.sql import types as T


@pytest.fixture()
def docs_of(spark):
    """Builds a documents-like table from (doc_id, text) pairs, with the other columns filled."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], schema)

    return make
