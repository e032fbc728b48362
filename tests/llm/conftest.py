import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from newsmetrics.llm.common import table  # noqa: F401  the subpackage must be importable here

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()),
                     StructField("toxic", IntegerType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts or (id, text) pairs, with columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        for name in ("score", "node", "key", "label", "hash", "n", "spans", "held", "h", "block"):
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


ODD = [None, "", " ", "\n\t", "a", "word " * 3000, "x" * 30_000, "é中😀 " * 50, "Same text, word for word, twice over and over.",
       "Same text, word for word, twice over and over."]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, ODD[7]), (3, "another text under id three")]
    return make_docs(rows)


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)
