"""Article pages of the two configured outlets, rendered from ``documents``, and what they hold.

Every document becomes one page in the markup of profile A (even ids) or B (odd ids); every 20th
belongs to an outlet that is not configured. The whole text is the page's body, one paragraph per
line, every fifth one a heading. Remainders of the id choose the markup of each field, so
that every selector, every missing field, error, live entry, caption and date form
occurs at a fixed rate. ``EXPECTED_SQL`` states the fields that the markup was made from; it
parses no HTML.

Remainders (n = doc_id, k = n // 2); A: date k % 7, title k // 7 % 5, author k % 4, abstract k % 3, body
k % 6, images k % 5. B: category k % 6, title k // 6 % 7, date k // 2 % 8, author k % 3, abstract k % 2,
no body k % 11, images k % 4, videos k % 5, video without source k % 7.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import spanish_date
from . import derived

#: Control characters and Unicode blanks other than the line feed; Java and RE2 read it alike.
BLANKS = r"[\x{00}-\x{09}\x{0b}-\x{1f}\x{7f}-\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def _text(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _wrap(markup: str, *values) -> Column:
    """Markup with ``{}`` where the values go; ``/`` in ``a.b/c`` nests elements, as in ``div.nota/p.fecha``."""
    parts = markup.split("{}")
    out = [F.lit(parts[0])]
    for v, p in zip(values, parts[1:]):
        out += [v if isinstance(v, Column) else F.lit(v), F.lit(p)]
    return F.concat(*out)


def nest(path: str, *values) -> Column:
    """Elements around the values: ``nest('div.nota p.fecha', x)``."""
    tags = [t.split(".") for t in path.split(" ")]
    begin = "".join(f"<{t}{f' class={chr(39)}' + ' '.join(c) + chr(39) if c else ''}>" for t, *c in tags)
    return F.concat(F.lit(begin), *values, F.lit("".join(f"</{t}>" for t, *_ in reversed(tags))))


def _choose(which: Column, *cases) -> Column:
    """The case whose number ``which`` is; nothing beyond them."""
    out = F.lit("")
    for i, c in enumerate(cases):
        out = F.when(which == i, c if isinstance(c, Column) else F.lit(c)).otherwise(out)
    return out


def _paragraphs(paragraph: str, heading: str) -> Column:
    return F.array_join(F.transform("paras", lambda p, i: F.when(i % 5 == 4, nest(heading, _text(p))).otherwise(nest(paragraph, _text(p)))), "")


def _markup_a(k: Column, n: Column) -> Column:
    date = spanish_date("day")
    dates = _choose(k % 7, nest("div.post-date", date), nest("div.autor-fecha-container p.fecha", date, F.lit(" | 10:30")),
                    nest("div.nota p.fecha", date), nest("div.nota-top-content div.top-content-text p.fecha", date),
                    F.concat(F.lit("<div class='post-date'> </div>"), nest("div.nota p.fecha", date)),
                    nest("div.fecha-visitas p.fecha", date, F.lit(" <span>12 visitas</span>")))
    title = _text(F.col("title"))
    titles = _choose(F.floor(k / 7) % 5, nest("h1.post-title", title), nest("h1.titulo", title),
                     nest("div.nota-top-content div.top-content-text h1.titular", title),
                     F.concat(F.lit("<h1 class='post-title'></h1>"), nest("h1.titulo", title)))
    name = F.col("author")
    authors = _choose(k % 4, nest("div.author div.creditos-nota div.autores span.autor b", name),
                      nest("div.autores-trust-project div.contenedor-datos", nest("p.nombres a", name), nest("p.cargo", F.lit("Cargo de "), name)),
                      nest("div.autor-opinion div.informacion", nest("a.nombre", name), nest("p.cargo", F.lit("Cargo de "), name)))
    summary = F.concat(F.lit("Resumen "), n)
    abstracts = _choose(k % 3, nest("div.post-main div.post-content div.post-excerpt p", summary),
                        nest("div.contenido-nota div.post-excerpt p", summary))
    body = _paragraphs("p", "h2")
    bodies = _choose(k % 6, nest("div.post-main div.post-content div.container-redes-contenido", body),
                     nest("div.container-redes-contenido div.contenido-nota", body),
                     nest("div.contenido-nota", _wrap("<div class='banners-contenido-nota-{} x'>", (n % 9).cast("string")), body, F.lit("</div>")),
                     nest("div.container-nota-body div.nota-content div.contenido", body),
                     nest("div.post-main div.post-content div.container-redes-contenido div.contenido-nota", body))
    images = _choose(k % 5, nest("div.post-main div.post-image", _wrap(
        "<img src=' /a{}.jpg '><img data-src='/b.jpg'><img data-lazy-src='/a{}.jpg'>", n, n)),
        _wrap("<div class='imagen' style=\"background-image: url('/c{}.jpg')\"></div>", n),
        nest("div.nota-top-content", _wrap("<img src='/d{}.jpg'>", n)), "<div class='post-main'><div class='post-image'><img></div></div>")
    return F.concat(dates, titles, authors, abstracts, images, bodies)


def _markup_b(k: Column, n: Column) -> Column:
    kind = k % 6
    section = F.when(kind == 3, F.lit(" EN VIVO ")).when(kind == 4, F.lit("Videos")).otherwise(F.lit("Política &amp; Economía"))
    sections = F.when(kind == 5, F.lit("")).otherwise(F.when(
        k % 2 == 0, nest("span.article-head__section__name", section)).otherwise(
        nest("span.article-head__section__name a.base-link", section)))
    titles = F.when(F.floor(k / 6) % 7 == 6, F.lit("")).otherwise(nest("h1.article-head__title", _text(F.col("title"))))
    iso = F.date_format("day", "yyyy-MM-dd")
    week = F.format_string("%04d-W%02d-%d", F.extract(F.lit("YEAROFWEEK"), "day"), F.weekofyear("day"), F.weekday("day") + 1)
    stamp = lambda *v: F.concat(F.lit("<time class='article-body__byline__date' datetime='"), *v, F.lit("'>x</time>"))
    dates = _choose(F.floor(k / 2) % 8, stamp(iso, F.lit("T09:01:00Z")), stamp(iso, F.lit("T09:01:00-03:00")), stamp(iso),
                    stamp(F.lit("2020-13-45")), stamp(F.lit("")), "<time class='article-body__byline__date'>x</time>", "",
                    stamp(week, F.lit("T10:00:00Z")))
    authors = _choose(k % 3, nest("a.article-body__byline__author", F.col("author")),
                      nest("span.article-body__byline__authors address", F.col("author")))
    abstracts = _choose(k % 2, nest("h2.article-head__subtitle", F.lit("Resumen "), n))
    body = F.when(k % 11 == 10, F.lit("")).otherwise(_paragraphs("p.article-body__paragraph", "h2.article-body__heading-h2"))
    entries = F.concat(
        nest("div.liveblog-entry", F.lit("<time class='liveblog-entry__date' datetime='"), iso, F.lit("T10:00:00Z'></time>"),
             nest("div.liveblog-entry__content", nest("h2", F.lit("Hora "), n), nest("p", _text(F.element_at("paras", 1)))),
             nest("p.article-body__paragraph", F.lit("dentro"))),
        F.lit("<div class='liveblog-entry'><div class='liveblog-entry__content'><p></p></div></div>"))
    video = F.when(k % 7 == 3, F.lit("<div class='article-body__raw-html'><iframe></iframe></div>")).otherwise(
        _wrap("<div class='article-body__raw-html'><iframe src='//v.example/{}'></iframe></div>", n))
    bodies = F.when(kind == 4, video).when(kind == 3, F.concat(body, entries)).otherwise(body)
    figure = "<figure class='article-body__figure'>{}</figure>"
    images = _choose(k % 4, _wrap(figure, _wrap(
        "<img class='global-image' src='/i{}.jpg'><span class='article-body__figure__caption'>Pie <b>de</b> foto {}</span>", n, n)),
        F.concat(_wrap(figure, "<img class='global-image'>"), _wrap(figure, _wrap("<img class='global-image' data-src='/j{}.jpg'>", n))),
        _wrap(figure, "<img class='global-image'>"))
    videos = _choose(k % 5, _wrap("<div class='article-body__oembed'><iframe src='//yt.example/{}'></iframe></div>", n),
                     _wrap("<div class='article-body__oembed-youtube'><iframe data-src='https://yt2.example/{}'></iframe></div>", n))
    return F.concat(sections, titles, dates, authors, abstracts, images, videos, bodies)


def outlet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html), one page per document."""
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " ")
    d = derived.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.transform(F.split(clean, "\n"), lambda p: F.trim(p)).alias("paras"),
        F.concat(F.lit("Nota "), "doc_id", F.lit(" & <"), F.coalesce("source", F.lit("")), F.lit(">")).alias("title"),
        F.concat(F.lit("Autor "), F.col("doc_id") % 97).alias("author"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 700).cast("int")).alias("day"))
    n, k = F.col("page_id").cast("string"), F.floor(F.col("page_id") / 2)
    host = F.when(F.col("page_id") % 20 == 19, F.lit("www.otro.example")).when(
        F.col("page_id") % 2 == 0, F.lit("www.biobiochile.cl")).otherwise(F.lit("www.latercera.com"))
    page = F.when(F.col("page_id") % 2 == 0, _markup_a(k, n)).otherwise(_markup_b(k, n))
    return d.select("page_id", F.concat(F.lit("https://"), host, F.lit("/noticias/"), n).alias("url"),
                    F.concat(F.lit("<!DOCTYPE html><html><body><nav><a href='/'>Inicio</a></nav>\n"), page, F.lit("</body></html>")).alias("html"))


_DAY_NAMES = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"
_MONTHS = ("['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre',"
           "'noviembre','diciembre']")

EXPECTED_SQL = r"""
WITH d AS (
  SELECT doc_id AS n, doc_id // 2 AS k,
         list_transform(string_split(regexp_replace(coalesce(text, ''), '""" + BLANKS + r"""', ' ', 'g'), chr(10)),
                        lambda x: trim(x, ' ')) AS paras,
         'Nota ' || doc_id || ' & <' || coalesce(source, '') || '>' AS title, 'Autor ' || (doc_id % 97) AS author,
         DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER) AS day,
         CASE WHEN doc_id % 20 = 19 THEN 'X' WHEN doc_id % 2 = 0 THEN 'A' ELSE 'B' END AS profile FROM documents),
e AS (
  SELECT *, array_to_string(paras, chr(10)) AS body,
         array_to_string(list_filter(paras, lambda x: x <> ''), chr(10)) AS full_body,
         """ + _DAY_NAMES + r"""[isodow(day)] || ' ' || lpad(CAST(day(day) AS VARCHAR), 2, '0') || ' ' ||
         """ + _MONTHS + r"""[month(day)] || ' de ' || year(day) AS dia, strftime(day, '%Y-%m-%d') AS iso, k % 6 AS kind
  FROM d),
a AS (
  SELECT n, profile, CAST(NULL AS VARCHAR) AS error,
         CAST(NULL AS VARCHAR) AS categoria,
         CASE WHEN k // 7 % 5 = 4 THEN NULL ELSE title END AS titulo,
         CASE k % 7 WHEN 1 THEN dia || ' | 10:30' WHEN 6 THEN NULL ELSE dia END AS fecha,
         CASE WHEN k % 4 < 3 THEN author END AS autor,
         CASE WHEN k % 4 IN (1, 2) THEN 'Cargo de ' || author END AS desc_autor,
         CASE WHEN k % 3 < 2 THEN 'Resumen ' || n END AS abstract,
         CASE k % 6 WHEN 4 THEN body || chr(10) || body WHEN 5 THEN NULL ELSE body END AS cuerpo,
         CAST(NULL AS VARCHAR) AS en_vivo,
         CASE k % 5 WHEN 0 THEN '/a' || n || '.jpg|/b.jpg' WHEN 1 THEN '/c' || n || '.jpg' WHEN 2 THEN '/d' || n || '.jpg' END AS multimedia,
         'imagen' AS tipo_multimedia, CAST(NULL AS VARCHAR) AS imagenes, CAST(NULL AS VARCHAR) AS videos, false AS no_date
  FROM e WHERE profile = 'A'),
b AS (
  SELECT n, profile,
         CASE WHEN k // 2 % 8 = 5 THEN '''datetime''' WHEN kind = 5 THEN '''NoneType'' object has no attribute ''lower'''
              WHEN kind = 4 AND k % 7 = 3 THEN '''src''' END AS error,
         CASE kind WHEN 3 THEN 'EN VIVO' WHEN 4 THEN 'Videos' WHEN 5 THEN NULL ELSE 'Política & Economía' END AS categoria,
         CASE WHEN k // 6 % 7 = 6 THEN NULL ELSE title END AS titulo,
         CASE k // 2 % 8 WHEN 3 THEN '2020-13-45' WHEN 4 THEN NULL WHEN 6 THEN NULL ELSE dia END AS fecha,
         CASE WHEN k % 3 < 2 THEN author END AS autor, CAST(NULL AS VARCHAR) AS desc_autor,
         CASE WHEN k % 2 = 0 THEN 'Resumen ' || n END AS abstract,
         CASE WHEN kind = 4 THEN 'https://v.example/' || n WHEN k % 11 = 10 THEN NULL
              WHEN kind = 3 THEN NULLIF(full_body, '') ELSE body END AS cuerpo,
         CASE WHEN kind = 3 THEN iso || 'T10:00:00Z::Hora ' || n || CASE WHEN paras[1] <> '' THEN chr(10) || paras[1] ELSE '' END || '|-::-' END AS en_vivo,
         CAST(NULL AS VARCHAR) AS multimedia, CAST(NULL AS VARCHAR) AS tipo_multimedia,
         CASE k % 4 WHEN 0 THEN '/i' || n || '.jpg::Piedefoto ' || n WHEN 1 THEN '/j' || n || '.jpg::-' END AS imagenes,
         NULLIF(concat_ws('|', CASE k % 5 WHEN 0 THEN 'https://yt.example/' || n WHEN 1 THEN 'https://yt2.example/' || n END,
                          CASE WHEN kind = 4 AND k % 7 <> 3 THEN 'https://v.example/' || n END), '') AS videos,
         kind = 3 AS no_date
  FROM e WHERE profile = 'B'),
both_outlets AS (SELECT * FROM a UNION ALL SELECT * FROM b),
judged AS (
  SELECT *, CASE WHEN error IS NULL THEN concat_ws(',',
      CASE WHEN coalesce(fecha, '') = '' AND NOT no_date THEN 'fecha' END, CASE WHEN coalesce(titulo, '') = '' THEN 'titulo' END,
      CASE WHEN coalesce(cuerpo, '') = '' AND imagenes IS NULL THEN 'cuerpo' END) ELSE '' END AS missing
  FROM both_outlets)
"""

ARTICLES_SQL = EXPECTED_SQL + r"""
SELECT n AS page_id, CASE profile WHEN 'A' THEN 'biobiochile' ELSE 'latercera' END AS medio, profile,
       CASE WHEN error IS NULL THEN categoria END AS categoria, CASE WHEN error IS NULL THEN titulo END AS titulo,
       CASE WHEN error IS NULL THEN fecha END AS fecha, CASE WHEN error IS NULL THEN autor END AS autor,
       CASE WHEN error IS NULL THEN desc_autor END AS desc_autor, CASE WHEN error IS NULL THEN abstract END AS abstract,
       CASE WHEN error IS NULL THEN cuerpo END AS cuerpo, CASE WHEN error IS NULL THEN en_vivo END AS en_vivo,
       CASE WHEN error IS NULL THEN multimedia END AS multimedia, tipo_multimedia,
       CASE WHEN error IS NULL THEN imagenes END AS imagenes, CASE WHEN error IS NULL THEN videos END AS videos, missing,
       CASE WHEN error IS NULL AND missing = '' THEN 'success' ELSE 'error' END AS status,
       CASE WHEN error IS NOT NULL THEN 'Error en el scraping: ' || error WHEN missing <> '' THEN
         'Error en el scraping: Faltaron los siguientes parámetros críticos: [''' || replace(missing, ',', ''', ''') || ''']' END AS error
FROM judged
UNION ALL
SELECT n, 'www.otro.example', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '', 'error',
       'Medio no encontrado en configuraciones'
FROM d WHERE profile = 'X'
"""
