"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsmetrics.session import materialize, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col_name: str, folds: int, held: int) -> Column:
    """True where crc32 of the id as text leaves the remainder ``held`` (null id: text '')."""
    text = F.coalesce(F.col(col_name).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == held


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply) over uint64 values."""
    h = h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting holds for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def brief_shuffles(spark: SparkSession):
    """Shuffle files of the queries run inside go when each ends, not when the driver collects its garbage.

    For writes: a DataFrame that is run twice would shuffle anew.
    """
    return setting(spark, SHUFFLE_CLEANUP, "true")


def small_batches(spark: SparkSession, rows: int):
    """Spark sends Python workers at most so many rows at once."""
    return setting(spark, BATCH_ROWS, str(rows))


def written(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` that leaves no shuffle files."""
    with brief_shuffles(df.sparkSession):
        return materialize(df, name)


class Workspace:
    """Tables of one step in a folder of their own, which goes when the step's result has been written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        with brief_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes the tables of these names, or all."""
        for path in [f"{self.path}/{name}" for name in names] or [self.path]:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
