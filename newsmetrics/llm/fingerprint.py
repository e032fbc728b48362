"""Operator 12, document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's five-word shingles (a
shorter text is one shingle). The k smallest of two sketches' union are the sketch
of the texts together, so sketches merge in any order and estimate resemblance
(share of the union's sketch that both hold), containment and the number of
distinct shingles; with fewer than k shingles all three are exact.

``edited_fingerprints`` compares each text with its edited text, whose last half comes
from the next document in descending id, and with that document. The order is cut by
borders that Spark's range partitioning of the keys gives; every text goes to
the task of its range, each range's first text also to the range before, as the
successor of its last. Texts are shuffled once; a task holds one batch and one document
that waits for its successor.

Defined results: null and empty texts (and those without words) have the empty
fingerprint, of likeness 1 with each other and 0 with others; whole texts count, however long;
null ids come after all others; rows with equal id are ordered by a hash of their texts
and are documents of their own (also when equal; such rows share one task); the last document's
successor is the first, a single document's is itself; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmetrics.llm.common import table, texts
from newsmetrics.llm.shingles import window_hashes, word_hashes

SIZE = 5  # words of a shingle
K = 128
SALTS = 64
SIGN = np.uint64(1 << 63)  # turns unsigned order into signed order
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_shingles double")


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    found = np.unique(hashes)
    return found[:k]


def sketch(text: str, size: int = SIZE, k: int = K) -> np.ndarray:
    return smallest(window_hashes(word_hashes(text), size), k)


def merge(sketches: Iterable[np.ndarray], k: int = K) -> np.ndarray:
    return smallest(np.concatenate([np.zeros(0, np.uint64), *sketches]), k)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated intersection over union; 1 for two empty sets."""
    both = np.sort(np.concatenate((a, b)))
    again = np.concatenate((both[1:] == both[:-1], [False])) if len(both) else np.zeros(0, bool)
    first = np.concatenate(([True], both[1:] != both[:-1])) if len(both) else again
    union = again[first][:k]
    return float(union.mean()) if len(union) else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds, over the values that both sketches cover; 1 if a is empty."""
    if len(b) == k:
        a = a[a <= b[-1]]
    return float(np.isin(a, b).mean()) if len(a) else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0 ** 64)


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, size: int = SIZE, k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_shingles), one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [sketch(t, size, k) for t in texts(b)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([encode(a) for a in made], pa.string()),
                 pa.array([distinct(a, k) for a in made], pa.float64())], ["doc_id", "fingerprint", "n_shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string, n_shingles double")


def likeness(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Struct of resemblance, contained_a (in b), contained_b (in a) and n_union of two fingerprint columns."""
    @F.pandas_udf("resemblance double, contained_a double, contained_b double, n_union double")
    def compare(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y in zip(left.fillna("").map(decode), right.fillna("").map(decode)):
            rows.append((resemblance(x, y, k), containment(x, y, k), containment(y, x, k), distinct(merge((x, y), k), k)))
        return pd.DataFrame(rows, columns=["resemblance", "contained_a", "contained_b", "n_union"], dtype="float64")

    return compare(a, b)


def merged(sketched: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, fingerprint, n_shingles) of all fingerprints of a key.

    Each batch is merged before the shuffle; the k smallest of what is left are ranked
    per (key, salt), which Spark limits before its shuffle, and then per key.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            have: dict[str | None, list[np.ndarray]] = {}
            for g, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                have.setdefault(g, []).append(decode(f or ""))
            signed = [(merge(parts, k) ^ SIGN).view(np.int64) for parts in have.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.string()), pa.array(signed, pa.list_(pa.int64()))],
                                             [key, "hashes"])

    @F.pandas_udf("struct<fingerprint: string, n_shingles: double>")
    def finish(hashes: pd.Series) -> pd.DataFrame:
        made = [np.sort(np.asarray(h, np.int64).view(np.uint64) ^ SIGN) for h in hashes]
        return pd.DataFrame({"fingerprint": [encode(a) for a in made], "n_shingles": [distinct(a, k) for a in made]})

    # the empty sketch of a key that has no other leaves one null row
    rows = (sketched.select(F.col(key).cast("string").alias(key), "fingerprint").mapInArrow(fold, f"{key} string, hashes array<long>")
            .select(key, F.explode_outer("hashes").alias("_hash")).distinct()
            .withColumn("_salt", F.pmod(F.xxhash64("_hash"), F.lit(SALTS))))
    for whole in ([key, "_salt"], [key]):
        rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*whole).orderBy(F.col("_hash").asc_nulls_last())))
        rows = rows.where(F.col("_place") <= k).drop("_place")
    made = rows.groupBy(key).agg(F.collect_list("_hash").alias("_hashes")).select(key, finish("_hashes").alias("_made"))
    return made.select(key, "_made.fingerprint", "_made.n_shingles")


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, text, block, successor): sorted ranges of descending ids, one per task.

    A range's rows are followed by a copy of the next range's first row, marked ``successor``.
    """
    spark = docs.sparkSession
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long")).alias("down"),
                   F.xxhash64("text").alias("hash"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", key.alias("key"))
    dealt = keyed.select("key.*").repartitionByRange(ranges, "none", "down", "hash")
    firsts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("none", "down", "hash")).alias("key"))
    borders = sorted(tuple(r["key"]) for r in firsts.collect())  # at most one per range
    if not borders:
        return spark.createDataFrame([], "doc_id long, text string, block int, successor boolean")
    literal = F.array(*[F.struct(F.lit(n).alias("none"), F.lit(d).cast("long").alias("down"), F.lit(h).cast("long").alias("hash"))
                        for n, d, h in borders])
    top = 1 << (len(borders).bit_length() - 1)
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])
    block = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(borders)) & (F.try_element_at(F.col("borders"), F.least(at + step, F.lit(len(borders)))) <= F.col("key")),
        at + step).otherwise(at))
    placed = keyed.withColumn("borders", literal).withColumn("block", (block - 1).cast("int"))
    first = F.element_at("borders", F.col("block") + 1) == F.col("key")
    own = F.struct("block", F.lit(False).alias("successor"))
    before = F.struct(F.pmod(F.col("block") - 1, F.lit(len(borders))).cast("int").alias("block"), F.lit(True).alias("successor"))
    sent = placed.select("doc_id", "text", "key", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))).alias("to"))
    return (sent.select("doc_id", "text", "key", "to.block", "to.successor")
            .repartitionById(len(borders), F.col("block"))
            .sortWithinPartitions("block", "successor", "key")
            .select("doc_id", "text", "block", "successor"))


def edited_fingerprints(docs: DataFrame, size: int = SIZE, k: int = K) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they and the next document's are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (block, id, text, sketch) of the document whose successor comes next
        for b in batches:
            rows = []
            for doc_id, text, block, successor in zip(b.column("doc_id").to_pylist(), texts(b),
                                                      b.column("block").to_pylist(), b.column("successor").to_pylist()):
                if successor and waiting is None:
                    continue  # the first of equal rows has served already
                own = sketch(text, size, k)
                if waiting is not None:
                    _, before, old, known = waiting
                    half = len(old) // 2
                    edited = old[:len(old) - half] + text[:half]
                    new = sketch(edited, size, k)
                    rows.append((before, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                 encode(known), encode(new), resemblance(known, new, k), resemblance(known, own, k),
                                 distinct(known, k)))
                waiting = None if successor else (block, doc_id, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 3]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_ranges(docs, ranges).mapInArrow(run, RESULT)


def op12_bottom_k_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
