import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# further columns whose names the operators use themselves
CLASHING = ["key", "anchor", "node", "label", "start", "n_words", "digest", "slot", "score", "base", "positive"]


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns of clashing names."""

    def make(rows, clashing=True):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(c) for c in CLASHING})
        return df

    return make
