"""Structured Streaming forms (S4-S6, S8, ST1, ST2, ST5-ST11, K7).

Every query checkpoints under the session's shared ``spark.checkpoint.dir``
(never a machine-local folder on a cluster), so a lost executor or a restarted
driver resumes from the last committed micro-batch. Sinks are idempotent per
epoch (dynamic partition overwrite or upsert by key), which turns the
at-least-once delivery of the source into exactly-once tables (ST8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.jsonfn import CORRUPT, decode
from ..operators import scrape_log as L
from ..session import checkpoint_path
from ..sources import io

# ---- fixed values: log channels and the table each one feeds ----------------
CHANNELS = {
    "scheduler_logs": "scheduler_errors",
    "crawler_logs": "crawler_errors",
    "scraping_logs": "scraping_results",
    "control": "control",
}
# ---- end of fixed values ------------------------------------------------------

CHANNEL_SCHEMAS = {
    "scheduler_logs": schemas.ERROR_LOG,
    "crawler_logs": schemas.ERROR_LOG,
    "scraping_logs": schemas.SCRAPE_LOG_RAW,
    "control": schemas.CONTROL_LOG,
}

MESSAGE = T.StructType([T.StructField("channel", T.StringType()),
                        T.StructField("arrival_seq", T.LongType()),
                        T.StructField("value", T.StringType())])


def read_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One stream of (channel, arrival_seq, value) JSON lines; a Kafka source
    with the topic as channel is a drop-in replacement."""
    r = spark.readStream.schema(MESSAGE)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def read_url_tasks(spark: SparkSession, path: str) -> DataFrame:
    """URL-task messages."""
    return spark.readStream.schema(schemas.URL_TASK).json(path)


def read_articles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Article records written by the scrape job."""
    return spark.readStream.schema(schema).json(path)


def route_batch(batch: DataFrame, epoch: int, out: str, batch_id_col=None) -> None:
    """ST1 / ST2 / P4 / K4: fan one micro-batch out to one table per channel.

    Undecodable messages go to ``quarantine`` with their channel and text (the
    reference nacks and loses them). Each table is written idempotently for
    this epoch.
    """
    batch = batch.persist()
    try:
        bad = [batch.filter(~F.col("channel").isin(list(CHANNELS)) | F.col("channel").isNull())
               .select("channel", "arrival_seq", "value")]
        for channel, table in CHANNELS.items():
            schema = CHANNEL_SCHEMAS[channel]
            parsed = (batch.filter(F.col("channel") == channel)
                      .select("channel", "arrival_seq", "value", decode("value", schema).alias("r")))
            ok = F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()
            cols = [f.name for f in schema.fields if f.name != "arrival_seq"]
            good = parsed.filter(ok).select("arrival_seq", *[F.col(f"r.{c}").alias(c) for c in cols])
            if batch_id_col is not None and "id_logging_process" in good.columns:
                good = good.withColumn("id_logging_process", batch_id_col)
            io.append_log(good, f"{out}/{table}", epoch)
            bad.append(parsed.filter(~ok).select("channel", "arrival_seq", "value"))
        q = bad[0]
        for b in bad[1:]:
            q = q.unionByName(b)
        io.append_log(q, f"{out}/quarantine", epoch)
    finally:
        batch.unpersist()


def start_router(messages: DataFrame, out: str, name: str = "log_router",
                 available_now: bool = True, batch_id: int | None = None):
    """ST1 / ST10: run the router; ``available_now`` drains the backlog then stops."""
    spark = messages.sparkSession
    bid = F.lit(batch_id).cast("long") if batch_id is not None else None
    w = (messages.writeStream
         .option("checkpointLocation", checkpoint_path(spark, f"{name}/ckpt"))
         .foreachBatch(lambda df, ep: route_batch(df, ep, out, bid)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def live_progress_stream(logs: DataFrame) -> DataFrame:
    """ST7 / A14 / A16: running per-outlet counters of a scrape-log stream.

    Log rows are typed (D8 -> typed view) and aggregated by outlet; Spark
    keeps the per-outlet state in the checkpointed state store.
    """
    t = L.typed(logs)
    return t.groupBy("medio").agg(
        F.count_if(F.col("status") == "success").cast("long").alias("total_articulos_exitosos"),
        F.count_if(F.coalesce(F.col("status") != "success", F.lit(True))).cast("long")
         .alias("total_articulos_fallidos"),
        F.sum(F.when(F.col("dur_ms") > 0, F.col("dur_ms"))).alias("__dsum"),
        F.count(F.when(F.col("dur_ms") > 0, F.lit(1))).alias("__dn"),
        F.min("start_ts").alias("__t0"), F.max("finish_ts").alias("__t1"))


def progress_upsert(store_path: str):
    """K7 / K6 in foreachBatch: merge the updated outlets into the progress table.

    The batch holds only outlets whose counters changed (update mode); other
    outlets are kept. The new version is written next to the old one and the
    store is read back from the latest complete version, so a failed batch
    never leaves a half-written table.
    """
    from ..operators.metrics import upsert_by_medio

    def fn(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = batch.select(
            "medio", "total_articulos_exitosos", "total_articulos_fallidos",
            F.when(F.col("__dn") > 0, F.col("__dsum") / F.col("__dn")).otherwise(F.lit(0.0))
             .alias("duracion_promedio_ms"),
            F.date_format("__t0", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
            F.date_format("__t1", "yyyy-MM-dd HH:mm:ss").alias("ultima_actualizacion"))
        # a replayed epoch starts from the version before its own
        earlier = [v for v in versions(spark, store_path) if v < epoch]
        merged = upsert_by_medio(spark.read.parquet(_version(store_path, earlier[-1])), new) if earlier else new
        merged.write.mode("overwrite").parquet(_version(store_path, epoch))
        for v in earlier[:-1]:  # the last one stays for a replay
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_version(store_path, v))
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return fn


def _version(store_path: str, epoch: int) -> str:
    return f"{store_path}/v={epoch:012d}"


def versions(spark: SparkSession, store_path: str) -> list[int]:
    """The complete versions of a versioned table, oldest first; none if there is no table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName()[2:]) for p in found if fs.exists(done(p, "_SUCCESS")))


def latest_version(spark: SparkSession, store_path: str) -> DataFrame:
    """Read the newest complete version of a versioned table."""
    found = versions(spark, store_path)
    if not found:
        raise FileNotFoundError(store_path)
    return spark.read.parquet(_version(store_path, found[-1]))


def start_live_progress(logs: DataFrame, store_path: str, name: str = "live_progress",
                        available_now: bool = True):
    spark = logs.sparkSession
    w = (live_progress_stream(logs).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint_path(spark, f"{name}/ckpt"))
         .foreachBatch(progress_upsert(store_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def dedup_tasks(tasks: DataFrame, sent: DataFrame | None = None) -> DataFrame:
    """ST6 / J7: each URL is sent once. All URLs of the stream are remembered in its
    checkpointed state, which grows with the distinct URLs and is dealt over the
    executors by URL; ``sent`` (url) holds those of earlier runs."""
    fresh = tasks if sent is None else tasks.join(sent.select("url").distinct(), "url", "left_anti")
    return fresh.dropDuplicates(["url"])


def idle_batches_stream(events: DataFrame, ts: str = "ts", gap: str = "120 seconds",
                        watermark: str = "10 minutes", logger: str = "logger") -> DataFrame:
    """ST5 (stream): batches closed by inactivity, one per idle-separated run.

    ``session_window`` merges an event exactly at the gap and splits after it,
    matching the reference's strict ``> 120 s`` idle test.
    """
    # watermarks need TIMESTAMP; log times are zone-less and the session is UTC
    # Each logger instance has its own idle timer: sessions are keyed by the
    # logger id column (streaming session windows need a grouping key).
    ev = events.withColumn("__t", F.col(ts).cast("timestamp"))
    return (ev.withWatermark("__t", watermark)
            .groupBy(F.col(logger).alias("logger"), F.session_window(F.col("__t"), gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("logger", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "n_events"))


def scrape_outcome_sink(out: str, batch_id: int):
    """ST11 with P1 and P4: every outcome becomes a log record with both times, the duration and the
    working batch's id; successful articles also go to the article table.

    The micro-batch has the columns of ``extract_articles`` and arrival_seq, start_ts, finish_ts.
    Both writes replace what an earlier try of the epoch wrote.
    """
    def fn(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            io.append_log(batch.filter(F.col("status") == "success")
                          .drop("missing", "error", "status", "start_ts", "finish_ts"), f"{out}/articles", epoch)
            logs = L.build_log(batch.withColumn("fecha_publicacion", F.col("fecha")))
            io.append_log(L.stamp_batch(logs, batch_id), f"{out}/scrape_results", epoch)
        finally:
            batch.unpersist()
    return fn


def batch_lifecycle_stream(control: DataFrame) -> DataFrame:
    """ST4 (stream): the lifecycle per batch id as a stateful aggregation.

    The same aggregation as ``control.batch_lifecycle``; Spark keeps one state
    row per batch id (update mode), so a batch shows ``completed`` as soon as
    its end_batch_completed record arrives.
    """
    from ..operators.control import batch_lifecycle
    return batch_lifecycle(control)
