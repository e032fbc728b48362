"""Spark session settings used by tests, bench and the CLI helpers."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on: UTC wall clock (log times carry no zone),
# AQE for partition coalescing / skew splits / runtime broadcast choice, Arrow for
# the one mapInPandas step.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "newsmetrics") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that the driver and all executors
    share, and is used as it is. Only a local session without it gets a scratch
    folder; on a cluster that would scatter a table's parts over machines.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="newsmetrics-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for written tables / streams)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder; it is deleted when the Python process ends."""
    import uuid
    folder = checkpoint_path(spark, f"tables-{spark.sparkContext.applicationId}")
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of re-running the
    work) and lets a plan use an expensive intermediate result, such as the
    output of the HTML step, in several branches without recomputing it.
    The application's written tables are deleted when its Python process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FOLDERS: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session or its gateway is gone already; the folder stays
        pass
