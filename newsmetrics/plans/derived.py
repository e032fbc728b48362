"""Pipeline inputs derived from the driver tables, identically in Spark and SQL.

The driver tables carry no scrape log, so one is derived from ``events`` (one
log per event, arrival order = ``event_id``). Each derivation exists twice: a
DataFrame form used by the Spark queries and a SQL text used by the DuckDB
oracle. Both must stay in step; the tests compare them.

Derived scrape log (D8):

* medio: even ``user_id`` -> biobiochile, odd -> latercera
* url: ``https://<medio>.example/noticias/<user_id>/<event_id % 40>`` (repeats, so
  A2 matters); '' for every 53rd event (F10)
* status: ``error`` for error events, else ``success``
* starting_time: ``ts`` to the second; '' for every 29th event (A7 skip)
* finishing_time: ``ts + round(value*1000) ms`` to the second; 'pendiente' (does
  not parse, F12) for every 37th event
* duration_ms: ``round(value*1000)`` as text; '' for every 17th event
* fecha_publicacion: '' on errors, else one of six forms by ``event_id % 6``
* id_logging_process: the run (batch) id = epoch seconds of the day start (DT7)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import batch_id
from ..functions.text import cached_expr

TABLES = ["events", "pages"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scrape_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(*_scrape_log_columns())


@cached_expr
def _scrape_log_columns() -> tuple:
    medio = F.when(F.col("user_id") % 2 == 0, F.lit("biobiochile")).otherwise(F.lit("latercera"))
    dms = F.round(F.col("value") * 1000).cast("long")
    status = F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("success"))
    ts = F.col("ts")
    fin = F.timestamp_add("MILLISECOND", dms, ts)
    k = F.col("event_id") % 6
    fecha = (F.when(k == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".24Z")))
             .when(k == 1, F.date_format(ts, "yyyy-MM-dd"))
             .when(k == 2, F.date_format(ts, "dd/MM/yyyy"))
             .when(k == 3, F.concat(F.date_format(ts, "yyyy/MM/dd"), F.lit(" | "),
                                    F.date_format(ts, "HH:mm")))
             .when(k == 4, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00")))
             .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")))
    return (
        F.col("event_id").alias("arrival_seq"),
        F.when(F.col("event_id") % 53 == 0, F.lit("")).otherwise(
            F.concat(F.lit("https://"), medio, F.lit(".example/noticias/"),
                     F.col("user_id").cast("string"), F.lit("/"),
                     (F.col("event_id") % 40).cast("string"))).alias("url"),
        medio.alias("medio"),
        F.when(F.col("event_id") % 29 == 0, F.lit(""))
         .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("starting_time"),
        status.alias("status"),
        F.when(status == "error", F.lit("")).otherwise(fecha).alias("fecha_publicacion"),
        F.when(F.col("event_id") % 37 == 0, F.lit("pendiente"))
         .otherwise(F.date_format(fin, "yyyy-MM-dd HH:mm:ss")).alias("finishing_time"),
        F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(dms.cast("string"))
         .alias("duration_ms"),
        F.when(status == "error", F.concat(F.lit("Error en el scraping: "), F.col("event_type")))
         .otherwise(F.lit("")).alias("error"),
        batch_id(F.date_trunc("day", ts).cast("timestamp_ntz")).alias("id_logging_process"),
    )


SCRAPE_LOG_SQL = """
scrape_log AS (
  SELECT
    event_id AS arrival_seq,
    CASE WHEN event_id % 53 = 0 THEN ''
         ELSE 'https://' || m || '.example/noticias/' || CAST(user_id AS VARCHAR) || '/'
              || CAST(event_id % 40 AS VARCHAR) END AS url,
    m AS medio,
    CASE WHEN event_id % 29 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS starting_time,
    st AS status,
    CASE WHEN st = 'error' THEN ''
         WHEN event_id % 6 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.24Z'
         WHEN event_id % 6 = 1 THEN strftime(ts, '%Y-%m-%d')
         WHEN event_id % 6 = 2 THEN strftime(ts, '%d/%m/%Y')
         WHEN event_id % 6 = 3 THEN strftime(ts, '%Y/%m/%d') || ' | ' || strftime(ts, '%H:%M')
         WHEN event_id % 6 = 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-03:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS fecha_publicacion,
    CASE WHEN event_id % 37 = 0 THEN 'pendiente'
         ELSE strftime(ts + to_milliseconds(dms), '%Y-%m-%d %H:%M:%S') END AS finishing_time,
    CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(dms AS VARCHAR) END AS duration_ms,
    CASE WHEN st = 'error' THEN 'Error en el scraping: ' || event_type ELSE '' END AS error,
    CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS id_logging_process
  FROM (SELECT *,
               CASE WHEN user_id % 2 = 0 THEN 'biobiochile' ELSE 'latercera' END AS m,
               CAST(round(value * 1000) AS BIGINT) AS dms,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS st
        FROM events) e
)"""

# Typed view of the derived log in SQL. The derived data only holds the forms
# listed above, so the oracle parses exactly those forms; the full parsers are
# covered by unit tests against plain Python.
TYPED_LOG_SQL = """
typed_log AS (
  SELECT arrival_seq, COALESCE(medio, 'unknown') AS medio, url, status,
         try_strptime(NULLIF(starting_time, ''), '%Y-%m-%d %H:%M:%S') AS start_ts,
         try_strptime(NULLIF(finishing_time, ''), '%Y-%m-%d %H:%M:%S') AS finish_ts,
         TRY_CAST(NULLIF(duration_ms, '') AS DOUBLE) AS dur_ms,
         CASE WHEN trim(fecha_publicacion) = '' THEN NULL
              ELSE COALESCE(
                 CASE WHEN d IS NOT NULL THEN
                   ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(d)]
                   || ' ' || lpad(CAST(day(d) AS VARCHAR), 2, '0') || ' '
                   || ['enero','febrero','marzo','abril','mayo','junio','julio','agosto',
                       'septiembre','octubre','noviembre','diciembre'][month(d)]
                   || ' de ' || CAST(year(d) AS VARCHAR) END,
                 p) END AS fecha,
         id_logging_process
  FROM (
    SELECT *,
      CAST(COALESCE(
        CASE WHEN p LIKE '%T%' AND (p LIKE '%Z%' OR p LIKE '%+%' OR right(p, 6) LIKE '%-%')
             THEN try_strptime(substr(p, 1, 10), '%Y-%m-%d') END,
        CASE WHEN regexp_matches(p, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
             THEN try_strptime(p, '%Y-%m-%d') END,
        CASE WHEN regexp_matches(p, '^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$')
             THEN try_strptime(p, '%d-%m-%Y') END,
        CASE WHEN regexp_matches(p, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$')
             THEN try_strptime(p, '%d/%m/%Y') END,
        CASE WHEN regexp_matches(p, '^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$')
             THEN try_strptime(p, '%Y/%m/%d') END) AS DATE) AS d
    FROM (SELECT *, trim(split_part(fecha_publicacion, '|', 1)) AS p FROM scrape_log) s
  ) q
)"""


def with_log_sql(body: str, typed: bool = True) -> str:
    ctes = [SCRAPE_LOG_SQL] + ([TYPED_LOG_SQL] if typed else [])
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 derived: one run per day; start at its first event, end received at its
    last event, end completed after the 120 s idle timeout."""
    from ..operators.control import IDLE_TIMEOUT_S, control_record
    e = table(spark, sf_dir, "events").select("ts")
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    g = e.groupBy(batch_id(day).alias("id")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    rows = F.explode(F.array(
        F.struct(F.lit("start_batch").alias("action"), F.col("a").alias("t")),
        F.struct(F.lit("end_batch_received").alias("action"), F.col("b").alias("t")),
        F.struct(F.lit("end_batch_completed").alias("action"),
                 F.timestamp_add("SECOND", F.lit(IDLE_TIMEOUT_S), F.col("b")).alias("t"))))
    x = g.select("id", rows.alias("r")).select("id", "r.action", "r.t")
    return control_record(x, "id", "action", "t")


CONTROL_LOG_SQL = """
control_g AS (
  SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS id, min(ts) AS a, max(ts) AS b
  FROM events GROUP BY 1
), control_log AS (
  SELECT id AS id_logging_process, 'start_batch' AS action,
         strftime(a, '%Y-%m-%d %H:%M:%S') AS timestamp FROM control_g
  UNION ALL
  SELECT id, 'end_batch_received', strftime(b, '%Y-%m-%d %H:%M:%S') FROM control_g
  UNION ALL
  SELECT id, 'end_batch_completed', strftime(b + INTERVAL 120 SECOND, '%Y-%m-%d %H:%M:%S')
  FROM control_g
)"""


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 derived: error events; origin by ``user_id % 3`` (the third origin is not
    accepted, F6); the crawler reports a URL as ``arg_medio`` (drift of D9)."""
    from ..operators.control import error_record
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error") \
        .select("event_id", "ts", "user_id", "props")
    medio = F.when(F.col("user_id") % 2 == 0, F.lit("biobiochile")).otherwise(F.lit("latercera"))
    origen = (F.when(F.col("user_id") % 3 == 0, F.lit("scheduler"))
              .when(F.col("user_id") % 3 == 1, F.lit("crawler")).otherwise(F.lit("notifier")))
    x = e.select(
        origen.alias("origen"), F.col("ts").alias("error_ts"),
        F.col("props").alias("error_detail"),
        F.when(origen == "crawler", F.concat(F.lit("https://"), medio, F.lit(".example/")))
         .otherwise(medio).alias("arg_medio"),
        F.when(origen == "scheduler", F.lit("scheduler_start"))
         .when(origen == "crawler", F.lit("crawl_categories")).alias("etapa"),
        batch_id(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")).alias("id_logging_process"))
    return error_record(x)


ERROR_LOG_SQL = """
err_e AS (
  SELECT *, CASE WHEN user_id % 2 = 0 THEN 'biobiochile' ELSE 'latercera' END AS m,
         CASE WHEN user_id % 3 = 0 THEN 'scheduler' WHEN user_id % 3 = 1 THEN 'crawler'
              ELSE 'notifier' END AS origen
  FROM events WHERE event_type = 'error'
), error_log AS (
  SELECT origen AS "from",
         CASE WHEN origen = 'crawler' THEN 'https://' || m || '.example/' ELSE m END AS arg_medio,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS error_timestamp,
         CASE WHEN origen = 'scheduler' THEN 'scheduler_start'
              WHEN origen = 'crawler' THEN 'crawl_categories' ELSE '' END AS stage,
         props AS error_detail,
         CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS id_logging_process,
         CASE WHEN origen IN ('scheduler', 'crawler') THEN 'accepted' ELSE 'rejected' END AS accepted
  FROM err_e
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the logger's queues, derived from ``events``; one batch per hour.

    An hour's events are sent within its first eighth. Handling takes ``value`` fifths of a
    second, 300 s more for every 97th event, and never happens for every 211th. The first message is
    start_batch; two hours in three send end_batch_received a second after their last event.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    into = F.timestamp_diff("MICROSECOND", hour, F.col("ts").cast("timestamp_ntz"))
    sent = F.timestamp_add("MICROSECOND", F.floor(into / 8).cast("long"), hour)
    e = e.select(batch_id(hour).alias("id_logging_process"), "event_id", "value", sent.alias("sent"))
    took = (F.round(F.col("value") * 200) + F.when(F.col("event_id") % 97 == 0, 300_000).otherwise(0)).cast("long")
    logs = e.select("id_logging_process", "sent",
                    F.when(F.col("event_id") % 211 != 0, F.timestamp_add("MILLISECOND", took, F.col("sent"))).alias("handled"),
                    F.lit(None).cast("string").alias("action"))
    span = e.groupBy("id_logging_process").agg(F.min("sent").alias("a"), F.max("sent").alias("b"))
    second = lambda n: F.timestamp_add("SECOND", F.lit(n), F.col("b"))
    ends = F.col("id_logging_process") / 3600 % 3 != 0
    control = F.array_compact(F.array(
        F.struct(F.col("a").alias("sent"), F.col("a").alias("handled"), F.lit("start_batch").alias("action")),
        F.when(ends, F.struct(second(1).alias("sent"), second(2).alias("handled"), F.lit("end_batch_received").alias("action")))))
    return logs.unionByName(span.select("id_logging_process", F.explode(control).alias("c")).select("id_logging_process", "c.*"))


QUEUE_MESSAGES_SQL = """
qe AS (
  SELECT CAST(epoch(h) AS BIGINT) AS id, event_id, value,
         h + to_microseconds((epoch_us(ts) - epoch_us(h)) // 8) AS sent
  FROM (SELECT *, date_trunc('hour', ts) AS h FROM events) x
), qspan AS (SELECT id, min(sent) AS a, max(sent) AS b FROM qe GROUP BY id
), messages AS (
  SELECT id, sent, CASE WHEN event_id % 211 <> 0 THEN sent + to_milliseconds(
           CAST(round(value * 200) AS BIGINT) + CASE WHEN event_id % 97 = 0 THEN 300000 ELSE 0 END) END AS handled,
         CAST(NULL AS VARCHAR) AS action FROM qe
  UNION ALL SELECT id, a, a, 'start_batch' FROM qspan
  UNION ALL SELECT id, b + INTERVAL 1 SECOND, b + INTERVAL 2 SECOND, 'end_batch_received' FROM qspan
            WHERE id // 3600 % 3 <> 0
)"""
