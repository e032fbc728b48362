"""Keyed tables whose versions replace each other atomically (K6-K8, ST6, ST8, ST9).

A table's rows are dealt into hash buckets of their key. A change writes the buckets it touches
as new Parquet folders and then one small file that names the folder of every bucket: the
version. Nothing is changed in place, so a reader that has taken a version sees all of it or nothing, and a
failed or repeated change leaves only folders that no version names.

Versions are compare-and-swap: version n + 1 is taken by renaming its file to a name that must
not exist yet (atomic on HDFS; an object store needs a conditional put). Who comes second
keeps its folders if the other change touched other buckets, else merges again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"
RETRIES = 20


class Conflict(RuntimeError):
    """Other writers took every version that this one tried for."""


class Files:
    """The few file system calls that versions need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file under a name that must be free; False if it is taken."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(draft, True)
        stream.write(text.encode())
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(draft, self.path(name), self.gateway.new_array(rename, 0))
            return True
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            self.remove(str(draft.toString()))
            return False

    def modified(self, name: str) -> int:
        return self.fs.getFileStatus(self.path(name)).getModificationTime()

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class VersionedTable:
    """Rows of ``schema`` dealt into ``buckets`` by ``keys``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str], buckets: int = 16):
        self.spark, self.root, self.keys, self.buckets = spark, path, keys, buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.files = Files(spark, path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # ---- versions
    def version(self, number: int | None = None) -> dict:
        """A version's file (the newest one by default); an empty table has version 0."""
        if number is None:
            found = [int(n[:-5]) for n in self.files.names(f"{self.root}/versions") if n.endswith(".json")]
            number = max(found, default=0)
        if not number:
            return {"version": 0, "parts": {}, "notes": {}}
        return json.loads(self.files.read(f"{self.root}/versions/{number:012d}.json"))

    def _commit(self, version: dict) -> bool:
        return self.files.create(f"{self.root}/versions/{version['version']:012d}.json", json.dumps(version))

    # ---- rows
    def read(self, version: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, of some buckets only if they are named."""
        parts = (version or self.version())["parts"]
        folders = [parts[str(b)] for b in (range(self.buckets) if buckets is None else buckets) if str(b) in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def merge(self, new: DataFrame, resolve: Callable[[DataFrame, DataFrame], DataFrame],
              notes: dict | None = None) -> dict:
        """Replace the touched buckets by ``resolve(their rows, new)`` and return the version made.

        ``resolve`` must give the same rows whether or not ``new`` has been merged
        before; then redelivered and replayed batches change nothing. ``notes`` are kept
        in the version's file.
        """
        touched = [r[0] for r in new.select(self.bucket().alias(BUCKET)).distinct().collect()]  # at most ``buckets``
        names = [f.name for f in self.schema.fields]
        base, written = None, {}
        for _ in range(RETRIES):
            now = self.version()
            if base is None or any(now["parts"].get(str(b)) != base["parts"].get(str(b)) for b in touched):
                base = now
                folder = f"data/{now['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
                rows = resolve(self.read(base, touched), new.select(*names)).select(*names)
                if touched:
                    (rows.withColumn(BUCKET, self.bucket()).repartition(len(touched), BUCKET)
                     .write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}"))
                made = set(self.files.names(f"{self.root}/{folder}"))
                written = {str(b): f"{folder}/{BUCKET}={b}" for b in touched if f"{BUCKET}={b}" in made}
            parts = {b: f for b, f in now["parts"].items() if int(b) not in touched} | written
            version = {"version": now["version"] + 1, "parts": parts, "notes": now["notes"] | (notes or {})}
            if self._commit(version):
                return version
        raise Conflict(f"{self.root}: no version could be taken in {RETRIES} tries")

    def vacuum(self, keep: int = 2, orphan_hours: float = 24) -> None:
        """Delete older versions and the folders that only they name; readers of the last ``keep`` stay whole.

        A folder that no version names may belong to a change under way; it goes once it is
        ``orphan_hours`` old.
        """
        numbers = sorted(int(n[:-5]) for n in self.files.names(f"{self.root}/versions") if n.endswith(".json"))
        versions = {n: self.version(n) for n in numbers}
        named = {n: {f.split("/")[1] for f in v["parts"].values()} for n, v in versions.items()}
        used = set().union(*(named[n] for n in numbers[-keep:]))
        seen = set().union(*named.values())
        now = self.jvm_millis()
        for name in self.files.names(f"{self.root}/data"):
            folder = f"{self.root}/data/{name}"
            if name not in used and (name in seen or now - self.files.modified(folder) > orphan_hours * 3_600_000):
                self.files.remove(folder)
        for n in numbers[:-keep]:
            self.files.remove(f"{self.root}/versions/{n:012d}.json")

    def jvm_millis(self) -> int:
        return self.files.jvm.java.lang.System.currentTimeMillis()


def first_of_key(keys: list[str], order: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of rows with equal keys the one smallest in ``order`` stays: a record keeps its first delivery."""
    return _one_of_key(keys, order, F.min_by)


def last_of_key(keys: list[str], order: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of rows with equal keys the one largest in ``order`` stays: an update replaces, an older one does not."""
    return _one_of_key(keys, order, F.max_by)


def _one_of_key(keys: list[str], order: str, pick) -> Callable[[DataFrame, DataFrame], DataFrame]:
    def resolve(old: DataFrame, new: DataFrame) -> DataFrame:
        whole = old.unionByName(new)
        rest = [c for c in whole.columns if c not in keys]
        best = whole.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(F.col(order), F.xxhash64(*rest))).alias("best"))
        return best.select(*keys, *[F.col("best")[c].alias(c) for c in rest])
    return resolve


def merge_sink(table: VersionedTable, resolve: Callable[[DataFrame, DataFrame], DataFrame], keep: int = 2):
    """ST8: a ``foreachBatch`` function. A message redelivered in this or a later epoch is merged
    with itself, and so is a replayed epoch."""
    def fn(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            table.merge(batch, resolve, {"epoch": epoch})
            table.vacuum(keep)
        finally:
            batch.unpersist()
    return fn
