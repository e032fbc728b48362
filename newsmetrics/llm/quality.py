"""Operator 9, quality classifier: boosted trees over document statistics.

One Python pass turns each text into about twenty statistics from its byte
histogram, words and lines; the trees are fitted on the driver from a bounded
sample of labelled rows and travel to the tasks as flat arrays.

Defined results: a null text counts as empty and still gets a score; documents
without label are scored alike; several labels of one id count as their
majority (a tie as 1), null labels are ignored; without usable labels the score
is 0.5 for all; texts of any length are read in whole; an empty table gives no rows. Rows are neither merged nor
dropped, and other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm import boosted
from newsmetrics.llm.common import fold, table, texts

FOLDS, HELD = 4, 2
THRESHOLD = 0.7
MAX_TRAIN_ROWS = 20_000  # bound of the labelled sample, the smallest hashes of the ids
SCORES = "doc_id long, score double"
SYMBOLS = np.array(list(b"#$%&*@^~_=+<>{}[]\\/"))


def statistics(text: str) -> list[float]:
    """Statistics of one text; every share has a total of at least 1 under it."""
    raw = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(len(raw), 1)
    tokens, lines = raw.split(), raw.split(b"\n")
    n = max(len(tokens), 1)
    seen = Counter(tokens)
    line_seen = Counter(lines)
    repeated = sum(len(k) * (v - 1) for k, v in line_seen.items())
    marked = sum(v for k, v in seen.items() if not (k[-1:].isalnum() or k[-1] >= 128 or k[-1:] in b".,"))
    return [
        np.log1p(len(raw)), np.log1p(len(tokens)), (len(raw) - count[32]) / n,
        len(seen) / n, max(seen.values(), default=0) / n,
        count[65:91].sum() / size, count[97:123].sum() / size, count[48:58].sum() / size,
        count[128:].sum() / size, count[32] / size, count[10] / size,
        count[33] / size, count[124] / size, count[SYMBOLS].sum() / size,
        (count[46] + count[44]) / size, marked / n,
        len(line_seen) / len(lines), repeated / size, max(map(len, tokens), default=0),
        sum(map(len, lines)) / len(lines),
    ]


FEATURES = len(statistics(""))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(t) for t in texts(batch)], float).reshape(-1, FEATURES)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = _matrix(b)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> boosted.Forest:
    """Fit on at most ``max_rows`` labelled ids outside the held-out fold.

    The sample's ids are broadcast (their number is the bound), so no text is
    shuffled; of several documents with one id any one counts.
    """
    ids = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                        & ~fold("doc_id", FOLDS, HELD))
           .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    known = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    rows = (known.mapInArrow(_features, "doc_id long, x array<double>")
            .groupBy("doc_id").agg(F.min("x").alias("x"))
            .join(F.broadcast(ids), "doc_id").collect())
    rows.sort(key=lambda r: r["doc_id"])
    return boosted.fit(np.array([r["x"] for r in rows], float).reshape(-1, FEATURES),
                       np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, forest: boosted.Forest) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(forest.probability(_matrix(b)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORES)


def keep_good(docs: DataFrame, forest: boosted.Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(forest.probability(_matrix(b)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_boosted_trees(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", fold("doc_id", FOLDS, HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
