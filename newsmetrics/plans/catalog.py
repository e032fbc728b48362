"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) and returns a lazy DataFrame. ``ORACLE`` holds the DuckDB
SQL for the same result where the operator is set-expressible; column names
match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import progress as P
from ..operators import scrape_log as L
from . import derived as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def typed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.typed(D.scrape_log(spark, sf_dir))


# ---------------------------------------------------------------- metrics core

_METRICS_SQL = """
, per_url AS (
  SELECT medio, url, {pick}(status, arrival_seq) AS status,
         min(start_ts) AS min_start, max(finish_ts) AS max_finish,
         sum(dur_ms) AS sum_dur_ms, count(dur_ms) AS n_dur
  FROM typed_log GROUP BY medio, url
), agg AS (
  SELECT medio,
         count(*) FILTER (WHERE url IS NOT NULL AND url <> '') AS total,
         count(*) FILTER (WHERE url IS NOT NULL AND url <> '' AND status = 'success') AS exitos,
         min(min_start) AS min_start, max(max_finish) AS max_finish,
         sum(sum_dur_ms) AS sum_dur_ms, sum(n_dur) AS n_dur
  FROM per_url GROUP BY medio
), m AS (
  SELECT *, CASE WHEN min_start IS NOT NULL AND max_finish IS NOT NULL
                 THEN CAST(epoch_us(max_finish) - epoch_us(min_start) AS DOUBLE) / 1e6
                 WHEN n_dur > 0 THEN sum_dur_ms / 1000.0 ELSE 0.0 END AS dur
  FROM agg
), metrics AS (
SELECT medio,
       CAST(total AS BIGINT) AS total_urls_procesadas,
       CAST(exitos AS BIGINT) AS scrape_exitosos,
       CAST(total - exitos AS BIGINT) AS scrape_fallidos,
       CASE WHEN total > 0 THEN CAST(exitos AS DOUBLE) / total * 100.0 ELSE 0.0 END AS porcentaje_exito,
       CAST(dur AS DOUBLE) AS duracion_segundos,
       CASE WHEN dur > 0 THEN exitos / (dur / 60.0) ELSE 0.0 END AS noticias_por_minuto,
       CASE WHEN exitos > 0 AND n_dur > 0 THEN (sum_dur_ms / 1000.0) / exitos ELSE 0.0 END
         AS tiempo_promedio_scrape
FROM m)"""


@register("A1_A9_outlet_metrics", D.with_log_sql(_METRICS_SQL.format(pick="arg_min") + "\nSELECT * FROM metrics"))
def q_outlet_metrics(spark, sf_dir):
    """A1-A9, A2 keep=oldest (the reference's actual behaviour)."""
    return M.outlet_metrics(typed_log(spark, sf_dir), keep="oldest")


@register("A2_outlet_metrics_latest", D.with_log_sql(_METRICS_SQL.format(pick="arg_max") + "\nSELECT * FROM metrics"))
def q_outlet_metrics_latest(spark, sf_dir):
    """A2 keep=latest (the documented intent)."""
    return M.outlet_metrics(typed_log(spark, sf_dir), keep="latest")


@register("A2_url_status", D.with_log_sql("""
SELECT medio, url, arg_min(status, arrival_seq) AS status
FROM typed_log WHERE url IS NOT NULL AND url <> '' GROUP BY medio, url"""))
def q_url_status(spark, sf_dir):
    """Final status of every processed URL."""
    t = typed_log(spark, sf_dir).filter(F.col("url").isNotNull() & (F.col("url") != ""))
    return M.url_status(t, status_text=True).select("medio", "url", "status")


@register("A10_publications_by_date", D.with_log_sql("""
SELECT medio, fecha, count(*) AS n FROM typed_log WHERE fecha IS NOT NULL
GROUP BY medio, fecha"""))
def q_publications(spark, sf_dir):
    """A10/DT3/STR8/F11: publications per normalised date (long form)."""
    return M.publications_by_date(typed_log(spark, sf_dir))


@register("A11_O1_histogram_order", D.with_log_sql("""
, h AS (SELECT medio, fecha, count(*) AS n FROM typed_log WHERE fecha IS NOT NULL
        GROUP BY medio, fecha)
SELECT medio, fecha, n,
       CAST(row_number() OVER (PARTITION BY medio ORDER BY fecha COLLATE C) AS BIGINT) AS pos
FROM h"""))
def q_histogram_order(spark, sf_dir):
    """Histogram keys in code-point order (position in the exported map)."""
    return M.histogram_ordered(M.publications_by_date(typed_log(spark, sf_dir)))


@register("A18_status_distribution", D.with_log_sql("""
SELECT medio, status, count(*) AS n FROM typed_log GROUP BY medio, status"""))
def q_status_distribution(spark, sf_dir):
    """Success / error distribution."""
    return M.status_distribution(typed_log(spark, sf_dir))


_PROGRESS_SQL = """
, prog AS (
  SELECT medio,
         CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS total_articulos_exitosos,
         CAST(count(*) FILTER (WHERE status IS NULL OR status <> 'success') AS BIGINT)
           AS total_articulos_fallidos,
         COALESCE(avg(CASE WHEN dur_ms > 0 THEN dur_ms END), 0.0) AS duracion_promedio_ms,
         min(start_ts) AS t0, max(finish_ts) AS t1, count(*) AS n
  FROM typed_log GROUP BY medio
), progress AS (
  SELECT medio, total_articulos_exitosos, total_articulos_fallidos, duracion_promedio_ms,
         CASE WHEN (CAST(epoch_us(t1) - epoch_us(t0) AS DOUBLE) / 1e6) / 60.0 > 0
              THEN n / ((CAST(epoch_us(t1) - epoch_us(t0) AS DOUBLE) / 1e6) / 60.0)
              ELSE 0.0 END AS articulos_por_minuto,
         COALESCE(strftime(t1, '%Y-%m-%d %H:%M:%S'), '') AS ultima_actualizacion,
         COALESCE(strftime(t0, '%Y-%m-%d %H:%M:%S'), '') AS start_time
  FROM prog
)"""


@register("A14_A16_live_progress", D.with_log_sql(_PROGRESS_SQL + "\nSELECT * FROM progress"))
def q_live_progress(spark, sf_dir):
    """A14-A16 / K7 / ST7 (batch form): progress snapshot per outlet."""
    return P.live_progress(typed_log(spark, sf_dir))


@register("A12_J1_corrected_metrics", D.with_log_sql(
    _METRICS_SQL.format(pick="arg_min") + _PROGRESS_SQL + """
, j AS (
  SELECT m.*, p.total_articulos_exitosos AS ok, p.total_articulos_fallidos AS ko,
         p.duracion_promedio_ms AS avg_ms,
         try_strptime(NULLIF(p.start_time, ''), '%Y-%m-%d %H:%M:%S') AS t0,
         try_strptime(NULLIF(p.ultima_actualizacion, ''), '%Y-%m-%d %H:%M:%S') AS t1,
         COALESCE(p.total_articulos_exitosos, 0) + COALESCE(p.total_articulos_fallidos, 0) AS tp
  FROM metrics m LEFT JOIN progress p USING (medio)
), u AS (
  SELECT *, (tp > 0 AND tp > total_urls_procesadas AND t0 IS NOT NULL AND t1 IS NOT NULL) AS use_p,
         CAST(epoch_us(t1) - epoch_us(t0) AS DOUBLE) / 1e6 AS real_s
  FROM j
)
SELECT medio,
  CASE WHEN use_p THEN CAST(tp AS BIGINT) ELSE total_urls_procesadas END AS total_urls_procesadas,
  CASE WHEN use_p THEN CAST(ok AS BIGINT) ELSE scrape_exitosos END AS scrape_exitosos,
  CASE WHEN use_p THEN CAST(ko AS BIGINT) ELSE scrape_fallidos END AS scrape_fallidos,
  CASE WHEN use_p THEN (CASE WHEN tp > 0 THEN CAST(ok AS DOUBLE) / tp ELSE 0.0 END) * 100.0
       ELSE porcentaje_exito END AS porcentaje_exito,
  CASE WHEN use_p THEN real_s ELSE duracion_segundos END AS duracion_segundos,
  CASE WHEN use_p THEN (CASE WHEN real_s > 0 THEN tp / (real_s / 60.0) ELSE 0.0 END)
       ELSE noticias_por_minuto END AS noticias_por_minuto,
  CASE WHEN use_p THEN avg_ms / 1000.0 ELSE tiempo_promedio_scrape END AS tiempo_promedio_scrape
FROM u"""))
def q_corrected_metrics(spark, sf_dir):
    """Log metrics corrected by the live progress snapshot."""
    t = typed_log(spark, sf_dir)
    return M.apply_progress(M.outlet_metrics(t), P.live_progress(t))


# ---------------------------------------------------------------- crawl / links

from .. import config  # noqa: E402
from ..config import PAGES_SITE  # noqa: E402
from ..operators import extract as X  # noqa: E402
from ..operators import links as K  # noqa: E402


def _pages(spark, sf_dir):
    return D.table(spark, sf_dir, "pages").select("page_id", "url", "html")


def _cands(spark, sf_dir):
    """News-link candidates of the pages, written once to the shared checkpoint
    folder: the HTML step runs once even when the plan uses them twice."""
    from ..session import materialize
    links = K.resolved_links(_pages(spark, sf_dir))
    c = K.news_candidates(links, PAGES_SITE["news_pattern"], PAGES_SITE["pagination_type"])
    return materialize(c, "news_candidates")


_LINKS_SQL = r"""
WITH pg AS (
  SELECT page_id, url AS category_url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) AS medio,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)', 1) AS slug,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)', 1) AS sch,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)', 2) AS auth,
         regexp_matches(url, '^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)') AS has_auth,
         regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs
  FROM pages
), anchors AS (
  SELECT page_id, medio, category_url, slug, sch, auth, has_auth,
         unnest(hrefs) AS href, unnest(generate_series(0, len(hrefs) - 1)) AS pos
  FROM pg
), links AS (
  SELECT *, CASE WHEN href LIKE '//%' AND has_auth THEN sch || ':' || href
                 WHEN href LIKE '/%' AND has_auth THEN sch || ':' || auth || href
                 ELSE href END AS link
  FROM anchors
), c0 AS (
  SELECT *,
    CASE WHEN strpos(link, '/especial/') > 0 THEN substr(link, strpos(link, '/especial/') + 10)
         WHEN strpos(link, '/noticias/') > 0 THEN substr(link, strpos(link, '/noticias/') + 10)
    END AS bb_path,
    list_filter(string_split(regexp_extract(link,
      '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/'), lambda x: x <> '') AS lt_segs
  FROM links WHERE strpos(link, '/the') > 0 OR strpos(link, '/of') > 0
), c1 AS (
  SELECT *, list_filter(string_split(bb_path, '/'), lambda x: x <> '') AS p0 FROM c0
), c2 AS (
  SELECT *, COALESCE(list_position(list_transform(p0, lambda x: regexp_full_match(x, '[0-9]{4}')),
                                   true), 0) AS yr FROM c1
), c3 AS (
  SELECT *, p0[1:CASE WHEN yr > 0 THEN least(yr - 1, 3) ELSE least(len(p0), 3) END] AS p1 FROM c2
), c4 AS (
  SELECT *, CASE WHEN lower(p1[1]) = 'biobiochile' THEN p1[2:] ELSE p1 END AS p2 FROM c3
), c5 AS (
  SELECT *, CASE WHEN len(p2) >= 2 AND lower(p2[2]) = 'noticias'
                 THEN list_concat(p2[1:1], p2[3:]) ELSE p2 END AS p3 FROM c4
), cands AS (
  SELECT DISTINCT medio, page_id, category_url,
    CASE WHEN strpos(link, 'biobiochile.cl') > 0 THEN
           CASE WHEN bb_path IS NULL OR bb_path = '' OR len(p3) = 0 THEN slug
                WHEN lower(p3[1]) = 'noticias-patrocinadas' THEN 'noticias-patrocinadas'
                ELSE array_to_string(p3, '/') END
         WHEN strpos(link, 'latercera.com') > 0 THEN COALESCE(lt_segs[1], 'sin-categoria')
         ELSE slug END AS categoria,
    link AS url
  FROM c5
)
"""


@register("X12_UD2_anchors", _LINKS_SQL + "SELECT page_id, pos, href, link FROM links")
def q_anchors(spark, sf_dir):
    """X12/UD2/STR3/F3/S7: anchors of every page, resolved against the page URL."""
    l = K.resolved_links(_pages(spark, sf_dir))
    return l.select("page_id", F.col("pos").cast("long").alias("pos"), "href", "link")


@register("X16_F1_category_links", _LINKS_SQL + """
SELECT DISTINCT medio, link AS category_url FROM links WHERE strpos(link, '/the') > 0""")
def q_category_links(spark, sf_dir):
    """Category links found on the pages."""
    return K.category_links(K.resolved_links(_pages(spark, sf_dir)), PAGES_SITE["category_pattern"])


@register("X17_STR1_news_candidates", _LINKS_SQL + "SELECT * FROM cands")
def q_news_candidates(spark, sf_dir):
    """X17/F2/J4/F15/STR1/STR2: news links per category page with their category tag."""
    return _cands(spark, sf_dir)


@register("X18_U1_news_links", _LINKS_SQL + "SELECT DISTINCT medio, categoria, url FROM cands")
def q_news_links(spark, sf_dir):
    """Distinct (categoria, url) pairs per outlet."""
    return K.news_links(_cands(spark, sf_dir))


@register("U3_J7_first_seen_links", _LINKS_SQL + """
SELECT url, categoria AS tags, medio FROM (
  SELECT *, row_number() OVER (PARTITION BY medio, url ORDER BY page_id, categoria) AS rn
  FROM cands) t WHERE rn = 1""")
def q_first_seen(spark, sf_dir):
    """U3/J7/K9/P5/ST6 (batch form): URL tasks, first category wins."""
    return K.first_seen(_cands(spark, sf_dir))


@register("A13_crawl_metrics", _LINKS_SQL + """
, cats AS (SELECT medio, count(DISTINCT category_url) AS total_categorias FROM pg GROUP BY medio)
, prs AS (SELECT medio, count(*) AS total_urls_encontradas
          FROM (SELECT DISTINCT medio, categoria, url FROM cands) GROUP BY medio)
SELECT medio, CAST(COALESCE(total_categorias, 0) AS BIGINT) AS total_categorias,
       CAST(COALESCE(total_urls_encontradas, 0) AS BIGINT) AS total_urls_encontradas,
       CASE WHEN COALESCE(total_categorias, 0) > 0
            THEN CAST(COALESCE(total_urls_encontradas, 0) AS DOUBLE) / total_categorias
            ELSE 0.0 END AS urls_por_categoria,
       0.0 AS duracion_segundos, 0.0 AS urls_por_minuto
FROM cats FULL OUTER JOIN prs USING (medio)""")
def q_crawl_metrics(spark, sf_dir):
    """A13/MA1/D12: crawl totals per outlet (run duration is an input; 0 here)."""
    return K.crawl_metrics(_pages(spark, sf_dir), _cands(spark, sf_dir))


@register("W1_A17_crawl_progress", _LINKS_SQL + """
, firsts AS (SELECT medio, categoria, url, min(page_id) AS page_id FROM cands
             GROUP BY medio, categoria, url)
, newp AS (SELECT medio, page_id, count(*) AS n_new FROM firsts GROUP BY medio, page_id)
, base AS (SELECT p.medio, p.page_id, COALESCE(n.n_new, 0) AS n_new
           FROM (SELECT DISTINCT medio, page_id FROM pg) p
           LEFT JOIN newp n ON n.medio = p.medio AND n.page_id = p.page_id)
, run AS (SELECT *, count(*) OVER w AS done, sum(n_new) OVER w AS found,
                 count(*) OVER (PARTITION BY medio) AS total
          FROM base WINDOW w AS (PARTITION BY medio ORDER BY page_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT medio AS sitio, page_id,
       CASE WHEN done = total THEN 'completed' ELSE 'running' END AS status,
       CAST(total AS BIGINT) AS total_categorias, CAST(done AS BIGINT) AS categorias_procesadas,
       CASE WHEN total > 0 THEN CAST(done AS DOUBLE) / total * 100.0 ELSE 0.0 END AS porcentaje,
       CAST(found AS BIGINT) AS urls_encontradas
FROM run""")
def q_crawl_progress(spark, sf_dir):
    """Crawl progress after each category page."""
    return K.crawl_progress(_pages(spark, sf_dir), _cands(spark, sf_dir))


# ---------------------------------------------------------------- article extraction

def _page_articles(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    cp = K.category_pages(pages).select("page_id", F.col("category_url").alias("url"),
                                         "medio", "html")
    return X.extract_articles(cp.withColumn("profile", F.lit(PAGES_SITE["profile"])))


_ARTICLE_SQL = r"""
WITH a AS (
  SELECT page_id, url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) AS medio,
         replace(replace(replace(replace(
           regexp_extract(html, '<article>.*?<h1>(.*?)</h1>', 1),
           '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS h1,
         regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1),
           '<h1>.*?</h1>', ''), '<[^>]*>', '', 'g') AS body_text
  FROM pages
)
SELECT page_id, url, medio, NULLIF(trim(h1), '') AS titulo,
       CASE WHEN trim(h1) <> '' AND regexp_matches(body_text, '[^\s]') THEN 'success'
            ELSE 'error' END AS status
FROM a"""


@register("X13_X15_page_articles", _ARTICLE_SQL)
def q_page_articles(spark, sf_dir):
    """X1/X11/X13-X15/F7/UD1/J6/S7: article outcome per page (profile G)."""
    return _page_articles(spark, sf_dir).select("page_id", "url", "medio", "titulo", "status")


# The body by an element stack: tokens of the article are taken one by one, an end tag closes the
# nearest open element of its name, and a text counts for every <p> that is open around it.
_BODY_SQL = r"""
WITH RECURSIVE part AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>|[^<]+') AS toks
  FROM pages),
walk AS (
  SELECT page_id, 0 AS i, toks, CAST([] AS STRUCT(tag VARCHAR, seq INTEGER)[]) AS stack FROM part
  UNION ALL
  SELECT page_id, i + 1, toks,
         CASE WHEN t LIKE '</%' THEN CASE WHEN pos > 0 THEN stack[1:len(stack) - pos] ELSE stack END
              WHEN t LIKE '<%' AND tag NOT IN ('', 'br', 'img', 'hr') THEN
                list_append(stack, {'tag': tag, 'seq': CAST(i + 1 AS INTEGER)})
              ELSE stack END
  FROM (SELECT *, coalesce(list_position(list_reverse(list_transform(stack, lambda x: x.tag)), tag), 0) AS pos
        FROM (SELECT *, toks[i + 1] AS t, lower(regexp_extract(toks[i + 1], '^</?([a-zA-Z0-9]+)', 1)) AS tag
              FROM walk WHERE i < len(toks)))),
pieces AS (
  SELECT page_id, i, unnest(stack) AS e, regexp_replace(replace(replace(replace(replace(toks[i],
         '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS txt
  FROM walk WHERE i > 0 AND toks[i] NOT LIKE '<%'),
open_tags AS (
  SELECT page_id, e.seq AS seq, e.tag AS tag, string_agg(txt, ' ' ORDER BY i) AS txt
  FROM pieces WHERE txt <> '' GROUP BY ALL),
found AS (
  SELECT page_id, string_agg(txt, chr(10) ORDER BY seq) FILTER (WHERE tag = 'p') AS cuerpo,
         max(txt) FILTER (WHERE tag = 'h1') AS titulo FROM open_tags GROUP BY page_id),
missed AS (
  SELECT pages.page_id, cuerpo, concat_ws(',', CASE WHEN titulo IS NULL THEN 'titulo' END,
         CASE WHEN cuerpo IS NULL THEN 'cuerpo' END) AS missing
  FROM pages LEFT JOIN found USING (page_id))
SELECT page_id, cuerpo, missing, CASE WHEN missing <> '' THEN
  'Error en el scraping: Faltaron los siguientes parámetros críticos: [''' || replace(missing, ',', ''', ''') || ''']' END AS error
FROM missed"""


@register("X9_X11_page_bodies", _BODY_SQL)
def q_page_bodies(spark, sf_dir):
    """X11/STR9 (profile G): full article bodies; an unclosed <p> holds what follows it. X2 and X9 occur in
    ``J6_X13_X14_outlet_articles``."""
    return _page_articles(spark, sf_dir).select(
        "page_id", "cuerpo", F.array_join("missing", ",").alias("missing"), "error")


from . import outlet_pages as OP  # noqa: E402


def _flat_articles(articles: DataFrame) -> DataFrame:
    """Arrays as text, so that both engines compare them alike."""
    pair = lambda c, a, b: F.array_join(F.transform(c, lambda x: F.concat(
        F.coalesce(x[a], F.lit("-")), F.lit("::"), F.coalesce(x[b], F.lit("-")))), "|")
    return articles.select(
        "page_id", "medio", "profile", "categoria", "titulo", "fecha", "autor", "desc_autor", "abstract", "cuerpo",
        pair("cuerpo_en_vivo", "fecha", "cuerpo").alias("en_vivo"), F.array_join("multimedia", "|").alias("multimedia"),
        "tipo_multimedia", pair("imagenes", "url", "descripcion").alias("imagenes"), F.array_join("videos", "|").alias("videos"),
        F.array_join("missing", ",").alias("missing"), "status", "error")


@register("J6_X13_X14_outlet_articles", OP.ARTICLES_SQL)
def q_outlet_articles(spark, sf_dir):
    """X1-X10, X13-X15, F4, F7-F9, J6, S6, P8, DT2, U4, STR5-STR7: mixed pages of both outlets and an unknown one."""
    pages = OP.outlet_pages(spark, sf_dir)
    return _flat_articles(X.extract_outlet_pages(pages, config.sites_df(spark)))


# ---------------------------------------------------------------- control, errors, batches

from ..operators import control as C  # noqa: E402
from ..operators import document as DOC  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..streaming import stores as ST  # noqa: E402

_LOG_CTES = [D.SCRAPE_LOG_SQL, D.TYPED_LOG_SQL]


@register("P3_F5_control_log", D.with_ctes(D.CONTROL_LOG_SQL, body="SELECT * FROM control_log"))
def q_control_log(spark, sf_dir):
    """P3/F5/K11/DT7/DT6: control records of the runs (one run per day)."""
    return D.control_log(spark, sf_dir)


@register("ST4_batch_lifecycle", D.with_ctes(D.CONTROL_LOG_SQL, body="""
, lc AS (
  SELECT id_logging_process,
         min(CASE WHEN action = 'start_batch' THEN strptime(timestamp, '%Y-%m-%d %H:%M:%S') END) AS s,
         max(CASE WHEN action = 'end_batch_received' THEN strptime(timestamp, '%Y-%m-%d %H:%M:%S') END) AS r,
         max(CASE WHEN action = 'end_batch_completed' THEN strptime(timestamp, '%Y-%m-%d %H:%M:%S') END) AS c
  FROM control_log GROUP BY id_logging_process)
SELECT id_logging_process, strftime(s, '%Y-%m-%d %H:%M:%S') AS started,
       strftime(r, '%Y-%m-%d %H:%M:%S') AS end_received,
       strftime(c, '%Y-%m-%d %H:%M:%S') AS end_completed,
       CAST(epoch_us(c) - epoch_us(s) AS DOUBLE) / 1e6 AS duracion_segundos,
       CASE WHEN c IS NOT NULL THEN 'completed' ELSE 'open' END AS status
FROM lc"""))
def q_batch_lifecycle(spark, sf_dir):
    """ST4/ST10: batch lifecycle from the control log."""
    return C.batch_lifecycle(D.control_log(spark, sf_dir))


@register("ST4_ST5_batch_closing", D.with_ctes(D.QUEUE_MESSAGES_SQL, body="""
, acts AS (SELECT DISTINCT id, handled AS t FROM messages WHERE handled IS NOT NULL)
, gaps AS (SELECT id, t, lead(t) OVER (PARTITION BY id ORDER BY t) AS nxt FROM acts)
, quiet AS (SELECT id, t + INTERVAL 120 SECOND AS o, nxt FROM gaps
            WHERE nxt IS NULL OR epoch_us(nxt) - epoch_us(t) > 120000000)
, ended AS (SELECT id, min(handled) AS r FROM messages WHERE action = 'end_batch_received' GROUP BY id)
, ch AS (SELECT id, sent AS t, 1 AS q, 0 AS m FROM messages
         UNION ALL SELECT id, handled, -1, 0 FROM messages WHERE handled IS NOT NULL
         UNION ALL SELECT id, o, 0, 1 FROM quiet
         UNION ALL SELECT id, nxt, 0, -1 FROM quiet WHERE nxt IS NOT NULL
         UNION ALL SELECT id, r, 0, 1 FROM ended)
, run AS (SELECT id, t, sum(q) OVER w AS queued, sum(m) OVER w AS may FROM ch
          WINDOW w AS (PARTITION BY id ORDER BY t RANGE UNBOUNDED PRECEDING))
, closed AS (SELECT id, min(t) AS c FROM run WHERE queued = 0 AND may > 0 GROUP BY id
             HAVING min(t) <= (SELECT max(sent) FROM messages))
SELECT m.id AS id_logging_process,
       strftime(min(handled) FILTER (WHERE action = 'start_batch'), '%Y-%m-%d %H:%M:%S') AS started,
       strftime(max(r), '%Y-%m-%d %H:%M:%S') AS end_received, strftime(max(c), '%Y-%m-%d %H:%M:%S') AS end_completed,
       CASE WHEN max(c) IS NULL THEN NULL WHEN max(r) <= max(c) THEN 'end_received' ELSE 'idle' END AS reason,
       CASE WHEN max(c) IS NULL THEN 'open' ELSE 'completed' END AS status,
       count(*) FILTER (WHERE handled IS NOT NULL AND (c IS NULL OR handled <= c)) AS handled,
       count(*) FILTER (WHERE handled IS NULL OR handled > c) AS "left"
FROM messages m LEFT JOIN closed USING (id) LEFT JOIN ended USING (id) GROUP BY m.id"""))
def q_batch_closing(spark, sf_dir):
    """ST4/ST5/W6: batches close once their end is received or they idle, and their queues are empty."""
    messages = D.queue_messages(spark, sf_dir)
    closings = C.batch_closings(messages, messages.agg(F.max("sent")).scalar())
    return C.closed_lifecycle(messages, closings)


@register("ST3_current_batch_metrics", D.with_ctes(*_LOG_CTES, D.CONTROL_LOG_SQL, body=(
    _METRICS_SQL.format(pick="arg_min").replace(
        "FROM typed_log GROUP BY medio, url",
        "FROM typed_log WHERE id_logging_process = (SELECT arg_max(id_logging_process, "
        "(strptime(timestamp, '%Y-%m-%d %H:%M:%S'), id_logging_process)) FROM control_log "
        "WHERE action = 'start_batch') GROUP BY medio, url")
    + "\nSELECT * FROM metrics")))
def q_current_batch_metrics(spark, sf_dir):
    """ST3/K5: metrics of the current batch only (logs after the last start_batch)."""
    logs = L.current_batch(typed_log(spark, sf_dir), D.control_log(spark, sf_dir))
    return M.outlet_metrics(logs)


@register("ST5_idle_sessions", """
WITH e AS (SELECT ts, event_id, lag(ts) OVER (ORDER BY ts, event_id) AS pts FROM events),
f AS (SELECT *, CASE WHEN pts IS NULL OR epoch_us(ts) - epoch_us(pts) > 120000000 THEN 1 ELSE 0 END
             AS nw FROM e),
s AS (SELECT *, sum(nw) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM f)
SELECT CAST(session AS BIGINT) AS session,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(ts) + INTERVAL 120 SECOND, '%Y-%m-%d %H:%M:%S') AS session_end,
       CAST(count(*) AS BIGINT) AS n_events
FROM s GROUP BY session""")
def q_idle_sessions(spark, sf_dir):
    """ST5: logger batches closed by 120 s of inactivity (gaps and islands)."""
    return C.idle_sessions(D.table(spark, sf_dir, "events"))


@register("P2_F6_error_log", D.with_ctes(D.ERROR_LOG_SQL, body="SELECT * FROM error_log"))
def q_error_log(spark, sf_dir):
    """Error records, accepted or quarantined by origin."""
    return D.error_log(spark, sf_dir)


# ---------------------------------------------------------------- versioned tables

EPOCHS = 4


def _deliveries(spark, sf_dir):
    """The derived log in four epochs; every fifth log comes again in the next epoch, every 35th also in its own."""
    logs = D.scrape_log(spark, sf_dir).withColumn("epoch", (F.col("arrival_seq") % EPOCHS).cast("int"))
    again = logs.where("arrival_seq % 5 = 0").withColumn("epoch", F.least(F.col("epoch") + 1, F.lit(EPOCHS - 1)))
    twice = logs.where("arrival_seq % 35 = 0")
    late = again.unionByName(twice).withColumn("arrival_seq", F.col("arrival_seq") + 1_000_000_000)
    return logs.unionByName(late)


_DELIVERIES_SQL = """
first_delivery AS (
  SELECT * FROM scrape_log
  QUALIFY row_number() OVER (PARTITION BY id_logging_process, medio, url, starting_time ORDER BY arrival_seq) = 1
), delivered AS (
  SELECT medio, count(*) + count(*) FILTER (WHERE arrival_seq % 5 = 0) + count(*) FILTER (WHERE arrival_seq % 35 = 0) AS n
  FROM scrape_log GROUP BY medio
)"""


@register("ST8_redelivered_logs", D.with_ctes(D.SCRAPE_LOG_SQL, _DELIVERIES_SQL, body="""
SELECT f.medio, CAST(any_value(d.n) AS BIGINT) AS delivered, count(*) AS kept,
       count(*) FILTER (WHERE status = 'success') AS exitosos,
       CAST(sum(TRY_CAST(NULLIF(duration_ms, '') AS BIGINT)) AS BIGINT) AS duration_sum, max(arrival_seq) AS last_seq
FROM first_delivery f JOIN delivered d ON f.medio = d.medio GROUP BY f.medio"""))
def q_redelivered_logs(spark, sf_dir):
    """ST8/K4: logs delivered again in the same or a later epoch count once, by merges into hash buckets."""
    deliveries = _deliveries(spark, sf_dir)
    table = ST.log_table(spark, scratch_path(spark, "redelivered"), buckets=16)
    for epoch in range(EPOCHS):
        ST.merge_sink(table, ST.first_of_key(ST.LOG_KEY, "arrival_seq"))(
            deliveries.where(F.col("epoch") == epoch).drop("epoch"), epoch)
    kept = table.read().groupBy("medio").agg(
        F.count("*").alias("kept"), F.count_if(F.col("status") == "success").alias("exitosos"),
        F.sum(F.col("duration_ms").try_cast("long")).alias("duration_sum"), F.max("arrival_seq").alias("last_seq"))
    n = deliveries.groupBy("medio").agg(F.count("*").alias("delivered"))
    return n.join(kept, "medio").select("medio", "delivered", "kept", "exitosos", "duration_sum", "last_seq")


@register("ST6_sent_urls", D.with_ctes(D.SCRAPE_LOG_SQL, body="""
SELECT url, min(arrival_seq // 500 % 4) AS epoch, count(*) AS asked
FROM scrape_log GROUP BY url"""))
def q_sent_urls(spark, sf_dir):
    """ST6/J7/U3: each URL is sent once over four epochs; older ones are found behind Bloom filters."""
    tasks = D.scrape_log(spark, sf_dir).select(
        "url", (F.floor(F.col("arrival_seq") / 500) % EPOCHS).cast("int").alias("epoch"),
        F.timestamp_seconds(F.col("arrival_seq")).alias("sent_at"))
    base = scratch_path(spark, "sent-urls")
    memory = ST.UrlMemory(spark, f"{base}/memory", buckets=8)
    for epoch in range(EPOCHS):
        memory.send(tasks.where(F.col("epoch") == epoch).select("url", "sent_at"), epoch, f"{base}/out")
    sent = spark.read.parquet(f"{base}/out").select("url", "epoch")
    return sent.join(tasks.groupBy("url").agg(F.count("*").alias("asked")), "url").select("url", "epoch", "asked")


@register("K7_K8_counters_after_reset", D.with_log_sql("""
, marks AS (SELECT medio, max(arrival_seq) AS reset_seq FROM typed_log
            WHERE medio = 'latercera' AND arrival_seq % 701 = 0 GROUP BY medio)
, live AS (SELECT t.* FROM typed_log t LEFT JOIN marks m USING (medio)
           WHERE m.reset_seq IS NULL OR t.arrival_seq > m.reset_seq)
, g AS (SELECT medio, count(*) FILTER (WHERE status = 'success') AS ok, count(*) FILTER (WHERE status <> 'success') AS ko,
               avg(dur_ms) FILTER (WHERE dur_ms > 0) AS mean, min(start_ts) AS a, max(finish_ts) AS b FROM live GROUP BY medio)
SELECT medio, ok AS total_articulos_exitosos, ko AS total_articulos_fallidos,
       round(COALESCE(mean, 0.0), 6) AS duracion_promedio_ms, strftime(b, '%Y-%m-%d %H:%M:%S') AS ultima_actualizacion,
       strftime(a, '%Y-%m-%d %H:%M:%S') AS start_time
FROM g"""))
def q_counters_after_reset(spark, sf_dir):
    """K6/K7/K8/ST7: running counters over four batches; an outlet's counters restart after its reset markers."""
    log = typed_log(spark, sf_dir)
    top = log.agg(F.max("arrival_seq")).scalar()
    marks = log.where("medio = 'latercera' AND arrival_seq % 701 = 0").select("medio", F.col("arrival_seq").alias("seq"))
    table = ST.counter_table(spark, scratch_path(spark, "counters"))
    for epoch in range(EPOCHS):
        quarter = lambda c: F.least(F.floor(F.col(c) * EPOCHS / (top + 1)), F.lit(EPOCHS - 1)) == epoch  # noqa: E731, B023
        ST.count_into(table, log.where(quarter("arrival_seq")), marks.where(quarter("seq")), epoch)
    return ST.progress_snapshot(table.read()).select(
        "medio", "total_articulos_exitosos", "total_articulos_fallidos",
        F.round("duracion_promedio_ms", 6).alias("duracion_promedio_ms"), "ultima_actualizacion", "start_time")


# ---------------------------------------------------------------- running progress and series

@register("W2_A15_running_progress", D.with_log_sql("""
, b AS (
  SELECT medio, arrival_seq, status, finish_ts,
         CASE WHEN status = 'success' THEN 1 ELSE 0 END AS ok,
         CASE WHEN status IS NULL OR status <> 'success' THEN 1 ELSE 0 END AS ko,
         CASE WHEN dur_ms > 0 THEN dur_ms ELSE 0.0 END AS d,
         CASE WHEN dur_ms > 0 THEN 1 ELSE 0 END AS dn,
         min(start_ts) OVER (PARTITION BY medio) AS t0
  FROM typed_log
), r AS (
  SELECT *, sum(ok) OVER w AS oks, sum(ko) OVER w AS kos, sum(d) OVER w AS ds, sum(dn) OVER w AS dns
  FROM b WINDOW w AS (PARTITION BY medio ORDER BY arrival_seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT medio, arrival_seq, status, CAST(oks AS BIGINT) AS ok_so_far, CAST(kos AS BIGINT) AS fail_so_far,
       CASE WHEN dns > 0 THEN ds / dns ELSE 0.0 END AS mean_ms_so_far,
       CASE WHEN (CAST(epoch_us(finish_ts) - epoch_us(t0) AS DOUBLE) / 1e6) / 60.0 > 0
            THEN (oks + kos) / ((CAST(epoch_us(finish_ts) - epoch_us(t0) AS DOUBLE) / 1e6) / 60.0)
            ELSE 0.0 END AS rate_per_min_so_far
FROM r"""))
def q_running_progress(spark, sf_dir):
    """W2/A14/A15/A16/ST7 (batch form): progress after every log."""
    return P.running_progress(typed_log(spark, sf_dir))


@register("W6_backlog", D.with_log_sql("""
, ev AS (
  SELECT medio, start_ts AS t, 0 AS kind, arrival_seq, 1 AS delta FROM typed_log
  WHERE start_ts IS NOT NULL
  UNION ALL
  SELECT medio, finish_ts, 1, arrival_seq, -1 FROM typed_log
  WHERE finish_ts IS NOT NULL AND start_ts IS NOT NULL
)
SELECT medio, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, kind, arrival_seq,
       CAST(sum(delta) OVER (PARTITION BY medio ORDER BY t, kind, arrival_seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS backlog
FROM ev"""))
def q_backlog(spark, sf_dir):
    """Tasks in flight (started minus finished) after every change."""
    return P.backlog(typed_log(spark, sf_dir))


_POLLS_SQL = """
, span AS (SELECT medio, min(t) AS t0, max(t) AS t1 FROM ch GROUP BY medio)
, polls AS (SELECT medio, unnest(generate_series(date_trunc('minute', t0), date_trunc('minute', t1),
                                                 INTERVAL 1 MINUTE)) AS t FROM span)
, u AS (SELECT medio, t, seq, 0 AS kind, {deltas} FROM ch
        UNION ALL SELECT medio, t, NULL, 1, {zeros} FROM polls)
, r AS (SELECT medio, t, kind, {sums} FROM u
        WINDOW w AS (PARTITION BY medio ORDER BY t, kind, seq NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, p AS (SELECT * FROM r WHERE kind = 1)"""


@register("W3_ST9_dashboard_series", D.with_log_sql("""
, ch AS (SELECT medio, COALESCE(start_ts, finish_ts) AS t, arrival_seq AS seq,
                CASE WHEN status = 'success' THEN 1 ELSE 0 END AS d_ok,
                CASE WHEN status IS NULL OR status <> 'success' THEN 1 ELSE 0 END AS d_ko
         FROM typed_log WHERE COALESCE(start_ts, finish_ts) IS NOT NULL)""" + _POLLS_SQL.format(
    deltas="d_ok, d_ko", zeros="0, 0",
    sums="sum(d_ok) OVER w AS exitosos, sum(d_ko) OVER w AS fallidos") + """
, c AS (SELECT *, lag(exitosos) OVER (PARTITION BY medio ORDER BY t) AS pe,
               lag(fallidos) OVER (PARTITION BY medio ORDER BY t) AS pf FROM p)
SELECT medio, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, CAST(exitosos AS BIGINT) AS exitosos,
       CAST(fallidos AS BIGINT) AS fallidos
FROM c WHERE NOT (COALESCE(pe, 0) = exitosos AND COALESCE(pf, 0) = fallidos)"""))
def q_dashboard_series(spark, sf_dir):
    """W3/ST9/A18: chart points from minute polls, emitted only on change."""
    return P.dashboard_series(typed_log(spark, sf_dir))


@register("W5_backlog_stalls", D.with_log_sql("""
, ch AS (SELECT medio, start_ts AS t, arrival_seq AS seq, 1 AS delta FROM typed_log
         WHERE start_ts IS NOT NULL
         UNION ALL
         SELECT medio, finish_ts, -arrival_seq - 1, -1 FROM typed_log
         WHERE finish_ts IS NOT NULL AND start_ts IS NOT NULL)""" + _POLLS_SQL.format(
    deltas="delta", zeros="0", sums="sum(delta) OVER w AS backlog") + """
, f AS (SELECT *, CASE WHEN lag(backlog) OVER (PARTITION BY medio ORDER BY t) IS NOT DISTINCT FROM backlog
                       THEN 0 ELSE 1 END AS st FROM p)
, i AS (SELECT *, sum(st) OVER (PARTITION BY medio ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT medio, CAST(island AS BIGINT) AS island, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first,
       strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last, CAST(min(backlog) AS BIGINT) AS backlog,
       CAST(count(*) AS BIGINT) AS polls
FROM i GROUP BY medio, island HAVING count(*) >= 10"""))
def q_backlog_stalls(spark, sf_dir):
    """Stalls, backlog unchanged for 10 consecutive minute polls."""
    return P.backlog_stalls(typed_log(spark, sf_dir), polls=10)


# ---------------------------------------------------------------- reconciliation, upsert, document

def _crawl_rows(spark, sf_dir):
    """Crawled URL tasks (medio, url) from the pages (U3 output)."""
    return K.first_seen(_cands(spark, sf_dir)).select("medio", "url")


_LINKS_CTES = _LINKS_SQL.strip()[len("WITH"):]
_FIRST_SEEN_SQL = """
, crawl AS (SELECT medio, url FROM (
    SELECT *, row_number() OVER (PARTITION BY medio, url ORDER BY page_id, categoria) AS rn
    FROM cands) t WHERE rn = 1)"""
_OK_URLS_SQL = """
, ok_urls AS (SELECT medio, url FROM typed_log WHERE url IS NOT NULL AND url <> ''
              GROUP BY medio, url HAVING arg_min(status, arrival_seq) = 'success')"""


@register("J3_A20_coverage", D.with_ctes(*_LOG_CTES, _LINKS_CTES, body=_FIRST_SEEN_SQL + _OK_URLS_SQL + """
, u AS (SELECT medio, 1 AS c, 0 AS s FROM crawl UNION ALL SELECT medio, 0, 1 FROM ok_urls)
SELECT medio, CAST(sum(c) AS BIGINT) AS crawled, CAST(sum(s) AS BIGINT) AS scraped_ok,
       CAST(sum(c) - sum(s) AS BIGINT) AS pending,
       CASE WHEN sum(c) = 0 THEN NULL ELSE CAST(sum(s) AS DOUBLE) / CAST(sum(c) AS DOUBLE) END AS ok_ratio
FROM u GROUP BY medio"""))
def q_coverage(spark, sf_dir):
    """Crawled vs scraped per outlet (union + one aggregate, no join)."""
    return P.coverage(_crawl_rows(spark, sf_dir), typed_log(spark, sf_dir))


@register("J3_missing_urls", D.with_ctes(*_LOG_CTES, _LINKS_CTES, body=_FIRST_SEEN_SQL + _OK_URLS_SQL + """
SELECT c.medio, c.url FROM crawl c
WHERE NOT EXISTS (SELECT 1 FROM ok_urls o WHERE o.medio = c.medio AND o.url = c.url)"""))
def q_missing_urls(spark, sf_dir):
    """J3 (row form): crawled URLs without a successful scrape (anti join)."""
    return P.missing_urls(_crawl_rows(spark, sf_dir), typed_log(spark, sf_dir))


_BATCH_METRICS_SQL = _METRICS_SQL.format(pick="arg_min") \
    .replace("SELECT medio, url,", "SELECT id_logging_process, medio, url,") \
    .replace("FROM typed_log GROUP BY medio, url", "FROM typed_log GROUP BY id_logging_process, medio, url") \
    .replace("  SELECT medio,\n         count(*)", "  SELECT id_logging_process, medio,\n         count(*)") \
    .replace("FROM per_url GROUP BY medio", "FROM per_url GROUP BY id_logging_process, medio") \
    .replace("), metrics AS (\nSELECT medio,", "), metrics AS (\nSELECT id_logging_process, medio,")


@register("K6_J2_U5_upsert_metrics", D.with_log_sql(_BATCH_METRICS_SQL + """
SELECT medio, total_urls_procesadas, scrape_exitosos, scrape_fallidos, porcentaje_exito,
       duracion_segundos, noticias_por_minuto, tiempo_promedio_scrape
FROM (SELECT *, row_number() OVER (PARTITION BY medio ORDER BY id_logging_process DESC) AS rn
      FROM metrics) t WHERE rn = 1"""))
def q_upsert_metrics(spark, sf_dir):
    """The metrics store after all runs, built with the upsert of the last run."""
    per_batch = M.outlet_metrics(typed_log(spark, sf_dir), by=("id_logging_process",))
    last = per_batch.agg(F.max("id_logging_process")).scalar()
    store = M.latest_per_medio(per_batch.filter(F.col("id_logging_process") < last))
    new = per_batch.filter(F.col("id_logging_process") == last).drop("id_logging_process")
    return M.upsert_by_medio(store, new)


_CRAWL_METRICS_SQL = """
, cats AS (SELECT medio, count(DISTINCT category_url) AS total_categorias FROM pg GROUP BY medio)
, prs AS (SELECT medio, count(*) AS total_urls_encontradas
          FROM (SELECT DISTINCT medio, categoria, url FROM cands) GROUP BY medio)
, crawl_metrics AS (
  SELECT medio, CAST(COALESCE(total_categorias, 0) AS BIGINT) AS total_categorias,
         CAST(COALESCE(total_urls_encontradas, 0) AS BIGINT) AS total_urls_encontradas,
         CASE WHEN COALESCE(total_categorias, 0) > 0
              THEN CAST(COALESCE(total_urls_encontradas, 0) AS DOUBLE) / total_categorias
              ELSE 0.0 END AS urls_por_categoria,
         0.0 AS duracion_segundos, 0.0 AS urls_por_minuto
  FROM cats FULL OUTER JOIN prs USING (medio))"""


@register("J5_P9_metrics_document", D.with_ctes(*_LOG_CTES, _LINKS_CTES, body=(
    _METRICS_SQL.format(pick="arg_min") + _PROGRESS_SQL + _CRAWL_METRICS_SQL + """
SELECT COALESCE(m.medio, p.medio, c.medio) AS medio,
       m.total_urls_procesadas AS m_total_urls_procesadas, m.scrape_exitosos AS m_scrape_exitosos,
       m.scrape_fallidos AS m_scrape_fallidos, m.porcentaje_exito AS m_porcentaje_exito,
       m.duracion_segundos AS m_duracion_segundos, m.noticias_por_minuto AS m_noticias_por_minuto,
       m.tiempo_promedio_scrape AS m_tiempo_promedio_scrape,
       p.total_articulos_exitosos AS p_total_articulos_exitosos,
       p.total_articulos_fallidos AS p_total_articulos_fallidos,
       p.duracion_promedio_ms AS p_duracion_promedio_ms, p.articulos_por_minuto AS p_articulos_por_minuto,
       p.ultima_actualizacion AS p_ultima_actualizacion, p.start_time AS p_start_time,
       c.total_categorias AS c_total_categorias, c.total_urls_encontradas AS c_total_urls_encontradas,
       c.urls_por_categoria AS c_urls_por_categoria, c.duracion_segundos AS c_duracion_segundos,
       c.urls_por_minuto AS c_urls_por_minuto
FROM metrics m FULL OUTER JOIN progress p ON p.medio = m.medio
     FULL OUTER JOIN crawl_metrics c ON c.medio = COALESCE(m.medio, p.medio)""")))
def q_metrics_document(spark, sf_dir):
    """J5/P9/S1/MP1: per-outlet metric document (scraper metrics, progress, crawler metrics)."""
    t = typed_log(spark, sf_dir)
    return DOC.metrics_document(M.outlet_metrics(t), P.live_progress(t),
                                K.crawl_metrics(_pages(spark, sf_dir), _cands(spark, sf_dir)))


@register("P10_P12_dashboard_row", D.with_log_sql(_PROGRESS_SQL + """
, act AS (SELECT min(medio) AS medio FROM progress)
SELECT p.medio, CASE p.medio WHEN 'biobiochile' THEN 'BioBio Chile'
                             WHEN 'latercera' THEN 'La Tercera' ELSE p.medio END AS medio_nombre,
       CAST(COALESCE(p.total_articulos_exitosos, 0) AS BIGINT) AS exitosos,
       CAST(COALESCE(p.total_articulos_fallidos, 0) AS BIGINT) AS fallidos,
       COALESCE(p.articulos_por_minuto, 0.0) AS tasa
FROM progress p JOIN act USING (medio)"""))
def q_dashboard_row(spark, sf_dir):
    """Dashboard numbers of the active outlet (no crawl in progress here)."""
    prog = P.live_progress(typed_log(spark, sf_dir))
    empty_crawl = prog.limit(0).select(F.lit(None).cast("string").alias("sitio"))
    active = DOC.active_outlet(empty_crawl, prog.select("medio"))
    return DOC.dashboard_row(prog, active).drop("timestamp") \
        .withColumn("tasa", F.coalesce("articulos_por_minuto", F.lit(0.0))) \
        .select("medio", "medio_nombre", "exitosos", "fallidos", "tasa")


@register("P12_active_crawl_outlet", D.with_log_sql(_PROGRESS_SQL + """
, latest AS (SELECT medio FROM typed_log WHERE start_ts IS NOT NULL
             ORDER BY start_ts DESC, arrival_seq DESC LIMIT 1)
SELECT p.medio, p.total_articulos_exitosos AS exitosos, p.total_articulos_fallidos AS fallidos,
       (SELECT min(medio) FROM progress) AS fallback
FROM progress p JOIN latest USING (medio)"""))
def q_active_crawl_outlet(spark, sf_dir):
    """The outlet of a running crawl (that of the latest log) goes before the first outlet."""
    log = typed_log(spark, sf_dir)
    crawl = log.where(F.col("start_ts").isNotNull()).agg(
        F.max_by("medio", F.struct("start_ts", "arrival_seq")).alias("sitio"))
    prog = P.live_progress(log)
    row = DOC.dashboard_row(prog, DOC.active_outlet(crawl, prog.select("medio")))
    return row.select("medio", "exitosos", "fallidos", prog.agg(F.min("medio")).scalar().alias("fallback"))


from . import catalog_outlets, catalog_streams  # noqa: E402,F401  they register their queries
