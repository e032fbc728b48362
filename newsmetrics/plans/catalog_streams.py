"""Registered queries that write the derived inputs as files, drain them through the streams and read the sinks.

Every stream runs with ``availableNow`` over all files of its input and ends; the result is what
its sink holds. Inputs, checkpoints and sinks lie in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config, schemas
from ..operators import extract as X
from ..operators import metrics as M
from ..session import materialize, scratch_path
from ..sources import io
from ..sources.versioned import VersionedTable, last_of_key
from ..streaming import closing, stores, streams
from . import derived as D
from . import outlet_pages as OP
from .catalog import _METRICS_SQL, _PROGRESS_SQL, register, typed_log

_LOG = [f.name for f in schemas.SCRAPE_LOG_RAW.fields]


def _files(df: DataFrame, name: str, parts: int = 4) -> str:
    """``df`` as JSON lines in about ``parts`` files of a new folder."""
    path = scratch_path(df.sparkSession, name)
    df.repartition(parts).write.json(path)
    return path


def _drained(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# ---------------------------------------------------------------- the router

_BROKEN = "'{\"id_logging_process\": \"x\", \"n\": ' || event_id || '}'"


@register("ST1_ST2_router", D.with_ctes(D.SCRAPE_LOG_SQL, D.ERROR_LOG_SQL, D.CONTROL_LOG_SQL, body="""
SELECT 'scraping_results' AS "table", 7 AS id_logging_process, url AS a, status AS b, starting_time AS c, arrival_seq AS seq FROM scrape_log
UNION ALL SELECT 'control', id_logging_process, action, timestamp, NULL, NULL FROM control_log
UNION ALL SELECT CASE "from" WHEN 'crawler' THEN 'crawler_errors' ELSE 'scheduler_errors' END, 7, arg_medio, stage, error_timestamp, NULL
          FROM error_log WHERE accepted = 'accepted'
UNION ALL SELECT 'quarantine', NULL, 'scraping_logs', '{"id_logging_process": "x", "n": ' || event_id || '}', NULL, -event_id
          FROM events WHERE event_id % 40 = 3
UNION ALL SELECT 'quarantine', NULL, 'nowhere', '{}', NULL, -event_id FROM events WHERE event_id % 40 = 4
"""))
def q_router(spark, sf_dir):
    """ST1/ST2/ST10/P2/P4/S5/K4/K10/K11/JS1: one stream of all channels into one table each; bad messages to quarantine."""
    logs, errors, control = D.scrape_log(spark, sf_dir), D.error_log(spark, sf_dir), D.control_log(spark, sf_dir)
    seq = F.lit(None).cast("long").alias("arrival_seq")
    events = D.table(spark, sf_dir, "events").select("event_id")
    bad = events.where("event_id % 40 IN (3, 4)").select(
        F.when(F.col("event_id") % 40 == 3, "scraping_logs").otherwise("nowhere").alias("channel"), (-F.col("event_id")).alias("arrival_seq"),
        F.when(F.col("event_id") % 40 == 3, F.expr(_BROKEN)).otherwise("{}").alias("value"))
    parts = [logs.select(F.lit("scraping_logs").alias("channel"), "arrival_seq", F.to_json(F.struct(*[c for c in _LOG if c != "arrival_seq"])).alias("value")),
             errors.where("accepted = 'accepted'").select(F.concat("from", F.lit("_logs")).alias("channel"), seq,
                                                          F.to_json(F.struct(*[c for c in errors.columns if c != "accepted"])).alias("value")), bad]
    # control messages keep their batch ids: they go through a router that stamps none
    out, out2 = scratch_path(spark, "router"), scratch_path(spark, "router")
    messages = parts[0].unionByName(parts[1]).unionByName(parts[2])
    name = out.rsplit("/", 1)[1]
    _drained(streams.start_router(streams.read_messages(spark, _files(messages, "messages"), 2), out, f"{name}-a", batch_id=7))
    told = control.select(F.lit("control").alias("channel"), seq, F.to_json(F.struct("*")).alias("value"))
    _drained(streams.start_router(streams.read_messages(spark, _files(told, "messages", 1)), out2, f"{name}-b"))

    def rows(table, a, b, c, root=out, seq="NULL", batch="id_logging_process"):
        return spark.read.parquet(f"{root}/{table}").selectExpr(
            f"'{table}' AS table", f"CAST({batch} AS BIGINT) AS id_logging_process", f"{a} AS a", f"{b} AS b",
            f"CAST({c} AS STRING) AS c", f"CAST({seq} AS BIGINT) AS seq")

    return (rows("scraping_results", "url", "status", "starting_time", seq="arrival_seq")
            .unionByName(rows("crawler_errors", "arg_medio", "stage", "error_timestamp"))
            .unionByName(rows("scheduler_errors", "arg_medio", "stage", "error_timestamp"))
            .unionByName(rows("quarantine", "channel", "value", "NULL", seq="arrival_seq", batch="NULL"))
            .unionByName(rows("control", "action", "timestamp", "NULL", root=out2)))


# ---------------------------------------------------------------- live progress, closing, sending

@register("ST7_live_progress_stream", D.with_log_sql(_PROGRESS_SQL + """
SELECT medio, total_articulos_exitosos, total_articulos_fallidos, round(duracion_promedio_ms, 6) AS duracion_promedio_ms,
       ultima_actualizacion, start_time FROM progress"""))
def q_live_progress_stream(spark, sf_dir):
    """ST7/K3/K7/A14/A15: counters of a log stream, each micro-batch a version of the progress table."""
    folder = _files(D.scrape_log(spark, sf_dir).select(_LOG), "logs")
    table = stores.counter_table(spark, scratch_path(spark, "live"))
    logs = spark.readStream.schema(schemas.SCRAPE_LOG_RAW).option("maxFilesPerTrigger", 2).json(folder)
    _drained(stores.start_feed(logs, table, table.root.rsplit("/", 1)[1], available_now=True))
    return stores.progress_snapshot(table.read()).select(
        "medio", "total_articulos_exitosos", "total_articulos_fallidos", F.round("duracion_promedio_ms", 6).alias("duracion_promedio_ms"),
        "ultima_actualizacion", "start_time")


@register("ST4_ST5_closing_stream", D.with_ctes(D.QUEUE_MESSAGES_SQL, body="""
, acts AS (SELECT DISTINCT id, handled AS t FROM messages WHERE handled IS NOT NULL)
, gaps AS (SELECT id, t, lead(t) OVER (PARTITION BY id ORDER BY t) AS nxt FROM acts)
, quiet AS (SELECT id, t + INTERVAL 120 SECOND AS o, nxt FROM gaps WHERE nxt IS NULL OR epoch_us(nxt) - epoch_us(t) > 120000000)
, ended AS (SELECT id, min(handled) AS r FROM messages WHERE action = 'end_batch_received' GROUP BY id)
, ch AS (SELECT id, sent AS t, 1 AS q, 0 AS m FROM messages
         UNION ALL SELECT id, handled, -1, 0 FROM messages WHERE handled IS NOT NULL
         UNION ALL SELECT id, o, 0, 1 FROM quiet UNION ALL SELECT id, nxt, 0, -1 FROM quiet WHERE nxt IS NOT NULL
         UNION ALL SELECT id, r, 0, 1 FROM ended)
, run AS (SELECT id, t, sum(q) OVER w AS queued, sum(m) OVER w AS may FROM ch
          WINDOW w AS (PARTITION BY id ORDER BY t RANGE UNBOUNDED PRECEDING))
, closed AS (SELECT id, min(t) AS c FROM run WHERE queued = 0 AND may > 0 GROUP BY id)
SELECT id AS id_logging_process, 'end_batch_completed' AS action, strftime(c, '%Y-%m-%d %H:%M:%S') AS timestamp,
       CASE WHEN r <= c THEN 'end_received' ELSE 'idle' END AS reason
FROM closed LEFT JOIN ended USING (id)
WHERE c <= (SELECT date_trunc('millisecond', greatest(max(sent), max(handled))) FROM messages) - INTERVAL 1 HOUR"""))
def q_closing_stream(spark, sf_dir):
    """ST4/ST5 as a stream: end records by event-time timers, up to the final watermark (one hour behind)."""
    m = D.queue_messages(spark, sf_dir)
    told = m.select("id_logging_process", F.col("sent").alias("t"), F.lit("sent").alias("kind"), "action").unionByName(
        m.where("handled IS NOT NULL").select("id_logging_process", F.col("handled").alias("t"), F.lit("handled").alias("kind"), "action"))
    folder, out = scratch_path(spark, "queue-events"), scratch_path(spark, "closings")
    told.write.parquet(folder)
    events = spark.readStream.schema(told.schema).parquet(folder)  # one micro-batch: files of a folder have no order
    _drained(closing.start_closing(events, out, out.rsplit("/", 1)[1], delay="1 hour"))
    return spark.read.schema(closing.RECORD).parquet(out)


@register("ST6_S4_sending_stream", D.with_ctes(D.SCRAPE_LOG_SQL, body="SELECT DISTINCT url, medio FROM scrape_log"))
def q_sending_stream(spark, sf_dir):
    """ST6/J7/S4/K9/P5: URL tasks of a stream, each URL sent once."""
    tasks = D.scrape_log(spark, sf_dir).select("url", F.lit("t").alias("tags"), "medio",
                                               F.timestamp_seconds("arrival_seq").cast("string").alias("sent_at"))
    folder, base = _files(tasks, "tasks"), scratch_path(spark, "sending")
    stream = spark.readStream.schema("url string, tags string, medio string, sent_at timestamp").json(folder)
    memory = stores.UrlMemory(spark, f"{base}/memory", buckets=4)
    _drained(stores.start_sending(stream, memory, f"{base}/out", base.rsplit("/", 1)[1], limit="3650 days"))
    sent = spark.read.parquet(f"{base}/out")
    owner = tasks.groupBy("url").agg(F.collect_set("medio").alias("m"))
    return sent.join(owner, "url").select("url", F.explode("m").alias("medio"))


# ---------------------------------------------------------------- articles, outcomes, snapshots

_RECORDS_SQL = OP.EXPECTED_SQL + """
SELECT n AS page_id, profile, categoria, titulo, fecha, autor, abstract, cuerpo, tipo_multimedia,
       'https://www.' || CASE profile WHEN 'A' THEN 'biobiochile.cl' ELSE 'latercera.com' END || '/noticias/' || n AS url
FROM judged WHERE error IS NULL AND missing = ''"""


@register("P6_P7_article_records", _RECORDS_SQL)
def q_article_records(spark, sf_dir):
    """Records of both outlets written as JSON lines per outlet and read back as a stream."""
    articles = materialize(X.extract_outlet_pages(OP.outlet_pages(spark, sf_dir), config.sites_df(spark)), "articles")
    parts = []
    for profile, made, schema in (("A", X.article_a(articles, outlet=True), schemas.ARTICLE_A), ("B", X.article_b(articles, outlet=True), schemas.ARTICLE_B)):
        folder, out = scratch_path(spark, "records"), scratch_path(spark, "records-read")
        io.write_articles(made, folder)
        stream = streams.read_articles(spark, folder, schema)
        _drained(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start())
        rows = spark.read.parquet(out)
        for c in ("categoria", "tipo_multimedia"):
            rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
        parts.append(rows.select(F.substring_index("url", "/", -1).cast("long").alias("page_id"), F.lit(profile).alias("profile"), "categoria",
                                 "titulo", "fecha", "autor", "abstract", "cuerpo", "tipo_multimedia", "url"))
    return parts[0].unionByName(parts[1])


@register("ST11_P1_outcomes", OP.ARTICLES_SQL.replace("\nSELECT n AS page_id, CASE profile", "\n, whole AS (SELECT n AS page_id, CASE profile") + """)
SELECT page_id AS arrival_seq, medio, strftime(TIMESTAMP '2025-01-01' + to_seconds(page_id), '%Y-%m-%d %H:%M:%S') AS starting_time, status,
       coalesce(CASE WHEN status = 'success' OR error LIKE '%Faltaron%' THEN fecha END, '') AS fecha_publicacion,
       CASE WHEN page_id % 9 = 4 THEN '' ELSE strftime(TIMESTAMP '2025-01-01' + to_seconds(page_id) + to_milliseconds(page_id % 5 * 250), '%Y-%m-%d %H:%M:%S') END AS finishing_time,
       CASE WHEN page_id % 9 = 4 THEN '' ELSE CAST(page_id % 5 * 250 AS VARCHAR) || '.0' END AS duration_ms,
       coalesce(error, '') AS error, 11 AS id_logging_process
FROM whole""")
def q_outcomes(spark, sf_dir):
    """ST11/K3/P1/P4/X15/P8: a stream of pages through extraction; every outcome a stamped log record, good ones also articles."""
    pages = OP.outlet_pages(spark, sf_dir)
    folder, out = scratch_path(spark, "pages"), scratch_path(spark, "outcomes")
    pages.write.parquet(folder)
    sink = streams.scrape_outcome_sink(out, 11)

    def scrape(batch: DataFrame, epoch: int) -> None:
        done = X.extract_outlet_pages(batch, config.sites_df(batch.sparkSession))
        start = F.timestamp_add("SECOND", F.col("page_id"), F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'"))
        finish = F.timestamp_add("MILLISECOND", F.col("page_id") % 5 * 250, start)
        sink(done.select("*", F.col("page_id").alias("arrival_seq"), start.alias("start_ts"),
                         F.when(F.col("page_id") % 9 != 4, finish).alias("finish_ts")), epoch)

    _drained(spark.readStream.schema(pages.schema).parquet(folder).writeStream.foreachBatch(scrape)
             .option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start())
    return spark.read.parquet(f"{out}/scrape_results").select(
        "arrival_seq", "medio", "starting_time", "status", "fecha_publicacion", "finishing_time", "duration_ms", "error", "id_logging_process")


@register("S1_K6_snapshot", D.with_log_sql(_METRICS_SQL.format(pick="arg_min") + """
SELECT medio, total_urls_procesadas, scrape_exitosos, scrape_fallidos, round(porcentaje_exito, 2) AS porcentaje_exito,
       round(duracion_segundos, 2) AS duracion_segundos, round(noticias_por_minuto, 3) AS noticias_por_minuto,
       round(tiempo_promedio_scrape, 3) AS tiempo_promedio_scrape,
       (SELECT count(DISTINCT fecha) FROM typed_log t WHERE t.medio = metrics.medio) AS fechas,
       (SELECT count(fecha) FROM typed_log t WHERE t.medio = metrics.medio) AS publicaciones
FROM metrics"""))
def q_snapshot(spark, sf_dir):
    """S1/K6/MA2/A11/D14/MP1: the rounded metrics snapshot with its histogram as one JSON file, read back."""
    log = typed_log(spark, sf_dir)
    rows = M.rounded_for_export(M.outlet_metrics(log)).join(M.histogram_map(M.publications_by_date(log)), "medio", "left")
    path = scratch_path(spark, "snapshot")
    io.export_snapshot(rows, path)
    back = io.read_snapshot(spark, path, schemas.SCRAPE_METRICS_VALUE)
    days = F.coalesce(F.map_values("publicaciones_por_fecha"), F.array().cast("array<long>"))
    return back.select("medio", "total_urls_procesadas", "scrape_exitosos", "scrape_fallidos", "porcentaje_exito", "duracion_segundos",
                       "noticias_por_minuto", "tiempo_promedio_scrape", F.size(days).cast("long").alias("fechas"),
                       F.aggregate(days, F.lit(0).cast("long"), lambda a, x: a + x).alias("publicaciones"))


_STORE_SQL = _METRICS_SQL.format(pick="arg_min") \
    .replace("SELECT medio, url,", "SELECT id_logging_process, medio, url,") \
    .replace("FROM typed_log GROUP BY medio, url", "FROM typed_log GROUP BY id_logging_process, medio, url") \
    .replace("  SELECT medio,\n         count(*)", "  SELECT id_logging_process, medio,\n         count(*)") \
    .replace("FROM per_url GROUP BY medio", "FROM per_url GROUP BY id_logging_process, medio") \
    .replace("), metrics AS (\nSELECT medio,", "), metrics AS (\nSELECT id_logging_process, medio,")


@register("K6_U5_two_writers", D.with_log_sql(_STORE_SQL + """
SELECT medio, id_logging_process, total_urls_procesadas, scrape_exitosos, porcentaje_exito
FROM metrics QUALIFY row_number() OVER (PARTITION BY medio ORDER BY id_logging_process DESC) = 1"""))
def q_two_writers(spark, sf_dir):
    """Two writers merge their outlets' runs into one store; one commits while the other is at work."""
    cols = ["medio", "id_logging_process", "total_urls_procesadas", "scrape_exitosos", "porcentaje_exito"]
    runs = materialize(M.outlet_metrics(typed_log(spark, sf_dir), by=("id_logging_process",)).select(*cols), "runs")
    path, keep = scratch_path(spark, "store"), last_of_key(["medio"], "id_logging_process")
    one, two = (VersionedTable(spark, path, runs.schema, ["medio"], buckets=1) for _ in range(2))
    first, second = ("medio = 'biobiochile'", "medio <> 'biobiochile'")
    one.merge(runs.where("id_logging_process % 172800 = 0"), keep)
    interrupted: list[bool] = []

    def slow(old: DataFrame, new: DataFrame) -> DataFrame:
        if not interrupted:
            interrupted.append(True)
            two.merge(runs.where(second), keep)
        return keep(old, new)

    one.merge(runs.where(first), slow)
    return one.read().select(*cols)
