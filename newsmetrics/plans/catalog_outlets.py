"""Registered queries over outlet category pages, references, raw lines and numbered files.

They give the crawl and ingestion operators inputs in which each of their arms occurs: two
outlets with patterns of their own, one with another pagination, unknown hosts, hrefs with dots and
foreign hosts, broken lines, URLs on both sides of the coverage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import urls
from ..operators import control as C
from ..operators import document as DOC
from ..operators import links as K
from ..operators import metrics as M
from ..operators import progress as P
from ..session import materialize, scratch_path
from ..sources import io
from ..sources.versioned import VersionedTable, last_of_key
from . import derived as D
from .catalog import _METRICS_SQL, _PROGRESS_SQL, register, typed_log
from .outlet_pages import _text

# ---------------------------------------------------------------- outlet category pages

#: A third outlet whose pages are numbered instead of loaded on demand.
NUMBERED = ("paginado", "https://www.paginado.example/", "canal", ["/nota/"], "numbered", "", 0, "G")


def sites(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*config.SITES, NUMBERED], schemas.SITE_CONFIG)


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category page per document; the outlet is the id's remainder by 4, the fourth is not configured."""
    n, s, u = F.col("doc_id").cast("string"), F.concat(F.lit("s"), F.col("doc_id") % 13), F.concat(F.lit("u"), F.col("doc_id") % 7)
    c = (F.col("doc_id") % 5).cast("string")

    def anchors(*hrefs) -> F.Column:
        return F.concat(*[F.concat(F.lit("<a href='"), h if not isinstance(h, tuple) else F.concat(
            *[F.lit(x) if isinstance(x, str) else x for x in h]), F.lit("'>x</a> ")) for h in hrefs])

    first = anchors(("/noticias/", s, "/", u, "/2024/05/", n, ".shtml"), ("//www.biobiochile.cl/noticias/biobiochile/", s, "/noticias/x", n),
                    ("/a/../noticias/./", s, "/p", n), ("/noticias/noticias-patrocinadas/", n), ("noticias/relativa/", n),
                    ("/lista/categorias/c", c), ("https://otro.example/noticias/x", n), (F.lit("/noticias/"),),
                    ("https://www.biobiochile.cl/especial/tema/noticias/z", n))
    second = anchors(("/", s, "/noticia/t-", n, "/ABC/"), ("//www.latercera.com/noticia/", n), ("/../", s, "/./noticia/q", n, "?x=/../y#f"),
                     ("https://externo.example/noticia/", n), ("/canal/c", c), (F.lit("https://www.latercera.com?/noticia/"),))
    kind = F.col("doc_id") % 4
    url = (F.when(kind == 0, F.concat(F.lit("https://www.biobiochile.cl/lista/categorias/cat"), c))
           .when(kind == 1, F.concat(F.lit("https://www.latercera.com/canal/cat"), c, F.lit("/")))
           .when(kind == 2, F.lit("https://www.paginado.example/canal/x")).otherwise(F.lit("https://www.otro.example/portada")))
    links = F.when(kind == 0, first).when(kind == 1, second).otherwise(F.lit("<a href='/nota/1'>x</a>"))
    return D.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), url.alias("url"),
        F.concat(F.lit("<html><body>"), links, F.lit("<p>"), _text(F.coalesce("text", F.lit(""))), F.lit("</p></body></html>")).alias("html"))


_OUTLET_LINKS_SQL = """
od AS (SELECT doc_id AS n, 's' || (doc_id % 13) AS s, 'u' || (doc_id % 7) AS u, doc_id % 5 AS c, doc_id % 4 AS kind FROM documents
), opages AS (
  SELECT n AS page_id, CASE kind WHEN 0 THEN 'biobiochile' WHEN 1 THEN 'latercera' WHEN 2 THEN 'paginado' END AS medio,
         CASE kind WHEN 0 THEN 'https://www.biobiochile.cl/lista/categorias/cat' || c
                   WHEN 1 THEN 'https://www.latercera.com/canal/cat' || c || '/'
                   WHEN 2 THEN 'https://www.paginado.example/canal/x' ELSE 'https://www.otro.example/portada' END AS category_url
  FROM od
), ofound AS (
  SELECT n AS page_id, unnest([
      {'c': s || '/' || u, 'l': 'https://www.biobiochile.cl/noticias/' || s || '/' || u || '/2024/05/' || n || '.shtml'},
      {'c': s, 'l': 'https://www.biobiochile.cl/noticias/biobiochile/' || s || '/noticias/x' || n},
      {'c': s || '/p' || n, 'l': 'https://www.biobiochile.cl/noticias/' || s || '/p' || n},
      {'c': 'noticias-patrocinadas', 'l': 'https://www.biobiochile.cl/noticias/noticias-patrocinadas/' || n},
      {'c': 'cat' || c, 'l': 'https://otro.example/noticias/x' || n},
      {'c': 'cat' || c, 'l': 'https://www.biobiochile.cl/noticias/'},
      {'c': 'tema/z' || n, 'l': 'https://www.biobiochile.cl/especial/tema/noticias/z' || n}]) AS x FROM od WHERE kind = 0
  UNION ALL
  SELECT n, unnest([
      {'c': s, 'l': 'https://www.latercera.com/' || s || '/noticia/t-' || n || '/ABC/'},
      {'c': 'noticia', 'l': 'https://www.latercera.com/noticia/' || n},
      {'c': s, 'l': 'https://www.latercera.com/' || s || '/noticia/q' || n || '?x=/../y#f'},
      {'c': '', 'l': 'https://externo.example/noticia/' || n},
      {'c': 'sin-categoria', 'l': 'https://www.latercera.com?/noticia/'}]) FROM od WHERE kind = 1
), ocands AS (
  SELECT medio, page_id, category_url, x.c AS categoria, x.l AS url FROM ofound JOIN opages USING (page_id)
)"""


@register("J4_S6_F15_outlet_links", D.with_ctes(_OUTLET_LINKS_SQL, body="""
SELECT medio, page_id, category_url, categoria, url, CAST(NULL AS VARCHAR) AS error FROM ocands
UNION ALL
SELECT NULL, page_id, category_url, NULL, NULL, 'Medio no encontrado en configuraciones' FROM opages WHERE medio IS NULL"""))
def q_outlet_links(spark, sf_dir):
    """J4/S6/F4/F15/X17/STR1-STR3: links by the patterns of each page's outlet; unknown outlets as errors."""
    cands, errors = K.outlet_candidates(category_pages(spark, sf_dir), sites(spark))
    unknown = errors.select(F.lit(None).cast("string").alias("medio"), "page_id", F.col("arg_medio").alias("category_url"),
                            F.lit(None).cast("string").alias("categoria"), F.lit(None).cast("string").alias("url"),
                            F.col("error_detail").alias("error"))
    return cands.withColumn("error", F.lit(None).cast("string")).unionByName(unknown)


@register("P9_P10_dashboard_document", D.with_ctes(D.SCRAPE_LOG_SQL, D.TYPED_LOG_SQL, _OUTLET_LINKS_SQL, body=(
    _METRICS_SQL.format(pick="arg_min") + _PROGRESS_SQL + """
, okinds AS (SELECT * FROM opages WHERE medio IN ('biobiochile', 'latercera'))
, cr AS (SELECT medio, count(DISTINCT category_url) AS cats FROM okinds GROUP BY medio)
, pr AS (SELECT medio, count(*) AS pairs FROM (SELECT DISTINCT medio, categoria, url FROM ocands) GROUP BY medio)
, pg AS (SELECT medio, count(*) AS pages FROM okinds GROUP BY medio)
SELECT m.medio, CASE m.medio WHEN 'biobiochile' THEN 'BioBio Chile' WHEN 'latercera' THEN 'La Tercera' ELSE m.medio END AS medio_nombre,
       'completed' AS estado, '100.0' AS porcentaje, pages AS categorias, pages AS total_categorias, pairs AS urls,
       pairs AS urls_final, printf('%.1f', pairs / (400.88 / 60.0)) AS urls_por_minuto,
       p.total_articulos_exitosos AS exitosos, p.total_articulos_fallidos AS fallidos,
       printf('%.1f', p.articulos_por_minuto) AS tasa, m.total_urls_procesadas AS procesadas,
       printf('%.1f', m.porcentaje_exito) AS porcentaje_exito, 4 AS parts
FROM metrics m JOIN progress p ON p.medio = m.medio JOIN cr ON cr.medio = m.medio JOIN pr ON pr.medio = m.medio
     JOIN pg ON pg.medio = m.medio""")))
def q_dashboard_document(spark, sf_dir):
    """All four parts per outlet; the crawl's progress snapshot is kept in a versioned table."""
    cands, _ = K.outlet_candidates(category_pages(spark, sf_dir), sites(spark))
    cands = materialize(cands, "outlet-candidates")
    pages = (config.with_outlet(category_pages(spark, sf_dir).withColumn("html", F.lit(None).cast("string")), sites(spark))
             .where("outlet <> 'paginado'").select("page_id", "url", "html", F.col("outlet").alias("medio")))
    snapshot = K.latest_crawl_progress(K.crawl_progress(pages, cands))
    table = VersionedTable(spark, scratch_path(spark, "crawl-progress"), snapshot.schema, ["medio"], buckets=1)
    table.merge(snapshot, last_of_key(["medio"], "categorias_procesadas"))
    log = typed_log(spark, sf_dir)
    doc = DOC.metrics_document(M.outlet_metrics(log), P.live_progress(log), K.crawl_metrics(pages, cands, 400.88), table.read())
    text = DOC.document_json(doc)
    parts = F.size(F.json_object_keys("document"))
    return DOC.dashboard_document(doc).join(text.select("medio", parts.alias("parts")), "medio")


# ---------------------------------------------------------------- references

_HREF = "regexp_replace(regexp_replace({}, '^([^#]*)#$', '\\1'), '^([^?#]*)[?](#.*)?$', '\\1\\2')"


@register("STR3_references", r"""
WITH l AS (
  SELECT page_id, url, regexp_extract(url, '^([^:]*)://([^/?#]*)', 1) AS sch, regexp_extract(url, '^[^:]*://([^/?#]*)', 1) AS host,
         regexp_extract(url, '^([^?#]*/)', 1) AS dir, regexp_extract(url, '^([^?#]*)', 1) AS bare, hrefs[i] AS h, i - 1 AS pos
  FROM (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)) x),
v AS (SELECT *, CASE WHEN (page_id + pos) % 6 = 3 AND regexp_matches(h, '[?#]') THEN 1 ELSE (page_id + pos) % 6 END AS kind FROM l),
r AS (SELECT page_id, pos, CASE kind WHEN 0 THEN '/a/b/../..' || h WHEN 1 THEN '/.' || h WHEN 2 THEN '//cdn.example' || h
             WHEN 3 THEN '/x' || h || '/..' WHEN 4 THEN 'hoja/../' || h[2:] ELSE '?q=' || pos END AS href,
      CASE WHEN kind IN (0, 1) THEN sch || '://' || host || h WHEN kind = 2 THEN sch || '://cdn.example' || h
           WHEN kind = 3 THEN sch || '://' || host || '/x/' WHEN kind = 4 THEN dir || h[2:] ELSE bare || '?q=' || pos END AS full, kind
      FROM v)
SELECT page_id, pos, href, CASE WHEN kind < 4 THEN """ + _HREF.format('"full"') + r""" ELSE href END AS link, "full" FROM r""")
def q_references(spark, sf_dir):
    """STR3/F3: hrefs with dot segments and hosts of their own, as the crawl resolves them and in full."""
    pages = D.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    a = K.extract.page_anchors(pages)
    which = (F.col("page_id") + F.col("pos")) % 6
    kind = F.when((which == 3) & F.col("href").rlike("[?#]"), 1).otherwise(which)
    h = F.col("href")
    made = F.lit(None)
    for k, c in {0: F.concat(F.lit("/a/b/../.."), h), 1: F.concat(F.lit("/."), h), 2: F.concat(F.lit("//cdn.example"), h),
                 3: F.concat(F.lit("/x"), h, F.lit("/..")), 4: F.concat(F.lit("hoja/../"), F.substring(h, 2, 1 << 30)),
                 5: F.concat(F.lit("?q="), "pos")}.items():
        made = F.when(kind == k, c).otherwise(made)
    a = a.select("page_id", F.col("pos").cast("long").alias("pos"), "url", made.alias("href"))
    return a.select("page_id", "pos", "href", urls.resolve_href("url", "href").alias("link"),
                    urls.resolve_reference("url", "href").alias("full"))


# ---------------------------------------------------------------- raw lines and numbered files

_BAD_LINES = {7: "''", 8: "'   '", 17: "'{\"arrival_seq\": ' || arrival_seq || ', \"url\": \"https'", 27: "'[' || arrival_seq || ']'",
              37: "'{\"arrival_seq\":\"x' || arrival_seq || '\",\"url\":\"u\"}'", 38: "'\"texto ' || arrival_seq || '\"'"}
_REASONS = {7: "blank", 8: "blank", 17: "not JSON", 27: "not an object", 37: "wrong type", 38: "not an object"}


@register("S2_JS2_quarantine", D.with_ctes(D.SCRAPE_LOG_SQL, body="SELECT " + ", ".join(
    f"CASE WHEN arrival_seq % 50 NOT IN (7, 8, 17, 27, 37, 38) THEN {c} END AS {c}" for c in ("arrival_seq", "url", "medio", "status", "duration_ms"))
    + ", CASE arrival_seq % 50 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _BAD_LINES.items()) + " END AS raw, CASE arrival_seq % 50 "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _REASONS.items()) + " END AS reason FROM scrape_log"))
def q_quarantine(spark, sf_dir):
    """S2/JS1/JS2/ST2/P4: JSON lines written and read back; bad ones carry their text and the reason."""
    log = D.scrape_log(spark, sf_dir)
    line = F.to_json(F.struct(*[f.name for f in schemas.SCRAPE_LOG_RAW.fields]))
    for k, text in _BAD_LINES.items():
        line = F.when(F.col("arrival_seq") % 50 == k, F.expr(text)).otherwise(line)
    path = scratch_path(spark, "lines")
    log.select(line.alias("value")).write.text(path)
    return io.decoded_lines(spark.read.text(path), schemas.SCRAPE_LOG_RAW).select(
        "arrival_seq", "url", "medio", "status", "duration_ms", "raw", "reason")


@register("S3_W4_crawl_csv", """
SELECT event_id + 1 AS idx, 'c' || (event_id % 7) AS categoria, 'https://x.example/n,"' || event_id AS url,
       event_id + 1 BETWEEN 11 AND 5000 AS in_range, event_id < (SELECT min(event_id) FROM events WHERE event_id % 1000 = 777) AS before_failure
FROM events""")
def q_crawl_csv(spark, sf_dir):
    """Rows numbered across files and splits, a range of them, those before the first failure."""
    e = D.table(spark, sf_dir, "events").select("event_id")
    path = scratch_path(spark, "crawl-csv")
    (e.repartitionByRange(5, "event_id").sortWithinPartitions("event_id")
     .select(F.concat(F.lit("c"), F.col("event_id") % 7).alias("categoria"), F.concat(F.lit('https://x.example/n,"'), "event_id").alias("url"))
     .write.csv(path, header=False))
    rows = materialize(io.read_crawl_csv(spark, path), "crawl-rows")
    number = F.substring_index("url", '"', -1).cast("long")
    judged = rows.withColumn("status", F.when(number % 1000 == 777, F.lit("error")).otherwise(F.lit("success")))
    ranged = io.row_range(rows, 11, 5000).select("idx", F.lit(True).alias("r"))
    before = io.until_first_failure(judged).select("idx", F.lit(True).alias("b"))
    no = F.lit(False)
    return (rows.join(ranged, "idx", "left").join(before, "idx", "left")
            .select("idx", "categoria", "url", F.coalesce("r", no).alias("in_range"), F.coalesce("b", no).alias("before_failure")))


# ---------------------------------------------------------------- one-second polls, coverage, control

@register("ST9_one_second_series", D.with_log_sql("""
, ch AS (SELECT medio, COALESCE(start_ts, finish_ts) AS t, status FROM typed_log WHERE COALESCE(start_ts, finish_ts) IS NOT NULL)
, per AS (SELECT medio, CASE WHEN t = date_trunc('second', t) THEN t ELSE date_trunc('second', t) + INTERVAL 1 SECOND END AS t,
                 count(*) FILTER (WHERE status = 'success') AS ok, count(*) FILTER (WHERE status IS DISTINCT FROM 'success') AS ko
          FROM ch GROUP BY ALL)
SELECT medio, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, CAST(sum(ok) OVER w AS BIGINT) AS exitosos, CAST(sum(ko) OVER w AS BIGINT) AS fallidos
FROM per WINDOW w AS (PARTITION BY medio ORDER BY t)"""))
def q_one_second_series(spark, sf_dir):
    """ST9/W3: what a reader of one-second snapshots sees, at the seconds with changes."""
    return P.dashboard_series(typed_log(spark, sf_dir), step_s=1)


_CRAWLED_SQL = """
crawled AS (SELECT DISTINCT medio, url FROM scrape_log WHERE arrival_seq % 5 <> 0 AND url <> ''
            UNION ALL SELECT medio, 'https://' || medio || '.example/pendiente/' || arrival_seq FROM scrape_log WHERE arrival_seq % 11 = 0
), ok_urls AS (SELECT medio, url FROM scrape_log WHERE url <> '' GROUP BY medio, url HAVING arg_min(status, arrival_seq) = 'success')"""


def _crawled(spark, sf_dir):
    log = D.scrape_log(spark, sf_dir)
    pending = F.concat(F.lit("https://"), "medio", F.lit(".example/pendiente/"), "arrival_seq")
    return (log.where("arrival_seq % 5 <> 0 AND url <> ''").select("medio", "url").distinct()
            .unionByName(log.where("arrival_seq % 11 = 0").select("medio", pending.alias("url"))))


@register("J3_A19_A20_outlet_coverage", D.with_ctes(D.SCRAPE_LOG_SQL, _CRAWLED_SQL, body="""
, u AS (SELECT medio, 1 AS c, 0 AS s FROM crawled UNION ALL SELECT medio, 0, 1 FROM ok_urls)
SELECT coalesce(medio, '*') AS medio, CAST(sum(c) AS BIGINT) AS crawled, CAST(sum(s) AS BIGINT) AS scraped_ok,
       CAST(sum(c) - sum(s) AS BIGINT) AS pending, CAST(sum(s) AS DOUBLE) / sum(c) AS ok_ratio
FROM u GROUP BY GROUPING SETS ((medio), ())"""))
def q_outlet_coverage(spark, sf_dir):
    """Outlets with crawled and scraped URLs, and the total over all of them."""
    per = P.coverage(_crawled(spark, sf_dir), typed_log(spark, sf_dir))
    return per.unionByName(P.coverage_total(per))


@register("J3_pending_urls", D.with_ctes(D.SCRAPE_LOG_SQL, _CRAWLED_SQL, body="""
SELECT medio, url FROM crawled WHERE (medio, url) NOT IN (SELECT (medio, url) FROM ok_urls)"""))
def q_pending_urls(spark, sf_dir):
    """J3 (row form): crawled URLs that no log names as a success; the anti join takes rows away."""
    return P.missing_urls(_crawled(spark, sf_dir), typed_log(spark, sf_dir))


@register("F5_control_actions", """
SELECT event_id AS id_logging_process, CASE event_type WHEN 'view' THEN 'start_batch' WHEN 'click' THEN 'end_batch_received'
         ELSE 'end_batch_completed' END AS action, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp
FROM events WHERE event_type IN ('view', 'click', 'purchase')""")
def q_control_actions(spark, sf_dir):
    """F5/P3/DT6: control records of five actions, two of which are not accepted."""
    action = (F.when(F.col("event_type") == "view", "start_batch").when(F.col("event_type") == "click", "end_batch_received")
              .when(F.col("event_type") == "purchase", "end_batch_completed").when(F.col("event_type") == "signup", "pause"))
    e = D.table(spark, sf_dir, "events").select("event_id", action.alias("action"), "ts")
    return C.control_record(e, "event_id", "action", "ts")


@register("A11_histogram_map", D.with_log_sql("""
SELECT medio, fecha, count(*) AS n FROM typed_log WHERE fecha IS NOT NULL GROUP BY medio, fecha"""))
def q_histogram_map(spark, sf_dir):
    """A11/MP1/D14: the histogram as the map that the metrics snapshot holds, read back by key."""
    per_day = M.publications_by_date(typed_log(spark, sf_dir))
    maps = M.histogram_map(per_day)
    return maps.select("medio", F.explode("publicaciones_por_fecha").alias("fecha", "n"))
