"""The corpus pipeline: five stages over ``documents``, each by one operator of ``newsmetrics.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows it gets and returns a
DataFrame; ``run`` writes each result as Parquet and hands it, reread, to the
next stage. All but the last stage return the columns they got.

1 quality        rows scored below the threshold go (labels of sf_dir train the trees)
2 near_copies    5-word shingles, similarity 0.8: of each group the smallest id stays
3 decontaminate  rows that hold a benchmark item go
4 redact         personal data becomes [EMAIL], [IP], [CARD], [PHONE]
5 encode         token counts and digests of ids and decoded text, one row per document

Defined results: empty tables pass through; null and empty texts are scored as empty, are copies of nothing, hold
no item and get no tokens; texts of any length go through in whole; rows with null ids are kept by the
stages that compare ids; rows that repeat id and text are kept once by stage 2;
extra columns are carried along until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmetrics.llm import bpe, decontaminate, jaccard_join, pii, quality
from newsmetrics.llm.common import table
from newsmetrics.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.accepted_cells(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, bpe.default_vocabulary())


STAGES = [("quality", good_quality), ("near_copies", one_of_each), ("decontaminate", without_benchmark),
          ("redact", without_personal_data), ("encode", encoded)]

#: Classifier, automaton and trees have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
