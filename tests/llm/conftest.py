import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that the operators might use inside.
CLASH = ("id", "key", "fp", "host", "path", "cell", "block", "out", "score", "rule", "line", "a", "b", "stack")


@pytest.fixture
def docs_of(spark):
    """A documents table of texts (or rows), with extra columns."""
    def make(texts, extra=True):
        rows = [t if isinstance(t, tuple) else (i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOC)
        if extra:
            from pyspark.sql import functions as F
            for c in CLASH:
                df = df.withColumn(c, F.lit("x"))
        return df
    return make
