import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from texts, with ids from 0 or from pairs (id, text); columns whose names clash with results ride along."""
    def make(texts, lang="en"):
        pairs = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t in pairs]
        extra = "1 as n_words", "'x' as id", "2 as kept", "3 as n_tokens", "'y' as token", "4 as doc", "5 as text_hash", "6 as start", "7 as words"
        extra += tuple(f"'{n}' as `{n}`" for n in ("_found", "_ratios", "_hash", "_base", "_weak", "_doc", "_0", "rep", "carried", "whole", "a.b", "x`y".replace("`", "")))
        return spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", *extra)

    return make
