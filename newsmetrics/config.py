"""Site configuration and extraction profiles (data, not code).

A new outlet is new rows here: a site row (D1/D2) and, if its markup differs,
a profile. Profiles map each article field to a rule kind and its ordered
selectors; rule kinds are implemented once in ``operators.extract``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

# ---- fixed values: configured outlets (start page, link patterns, paging) ----
SITES = [
    # medio, start_url, category_pattern, news_pattern, pagination_type,
    # load_more_selector, max_clicks, profile
    ("biobiochile", "https://www.biobiochile.cl/", "lista/categorias", ["/noticias/"],
     "loadmore", ".fetch-btn", 0, "A"),
    ("latercera", "https://www.latercera.com/", "canal", ["/noticia/"],
     "loadmore", ".result-list__see-more", 0, "B"),
]
# ---- end of fixed values ------------------------------------------------------

# Crawl settings for the driver's ``pages`` table (every page is a category
# page of the outlet named by its host; see README). Parameters, not reference
# values.
PAGES_SITE = {
    "category_pattern": "/the",
    "news_pattern": ["/the", "/of"],
    "pagination_type": "loadmore",
    "profile": "G",
}

# ---- fixed values: extraction profiles (field -> rule, ordered selectors) ----
PROFILE_A = {
    "fecha": [("text_first", ["div.post-date", "div.autor-fecha-container p.fecha",
                              "div.nota p.fecha",
                              "div.nota-top-content div.top-content-text p.fecha"]),
              ("own_text_first", ["div.fecha-visitas p.fecha"])],
    "titulo": [("text_first", ["h1.post-title", "h1.titulo",
                               "div.nota-top-content div.top-content-text h1.titular"])],
    "autor": [("text_first", ["div.autores-trust-project div.contenedor-datos p.nombres a",
                              "div.author div.creditos-nota div.autores span.autor b",
                              "div.autor-opinion div.informacion a.nombre",
                              "div.autor div.creditos-nota div.autores span.autor b a",
                              "div.container-nota-body span.autor b a"])],
    "desc_autor": [("text_first", ["div.autores-trust-project div.contenedor-datos p.cargo",
                                   "div.autor-opinion div.informacion p.cargo"])],
    "abstract": [("text_first", ["div.post-main div.post-content div.post-excerpt p",
                                 "div.contenido-nota div.post-excerpt p"])],
    "cuerpo": [("body", [
        "div.post-main div.post-content div.container-redes-contenido p, "
        "div.post-main div.post-content div.container-redes-contenido h2",
        "div.container-redes-contenido div.contenido-nota h2, "
        "div.container-redes-contenido div.contenido-nota p",
        "div.contenido-nota div[class^='banners-contenido-nota-'] h2, "
        "div.contenido-nota div[class^='banners-contenido-nota-'] p",
        "div.container-nota-body div.nota-content div.contenido p, "
        "div.container-nota-body div.nota-content div.contenido h2"])],
    "multimedia": [("images", ["div.post-main div.post-image img",
                               "div.post-main div.post-content div.container-redes-contenido img",
                               "div.imagen", "div.contenedor-imagen-titulo div.imagen img",
                               "div.nota-top-content img"])],
    "_constants": {"tipo_multimedia": "imagen"},
    "_required": ["fecha", "titulo", "cuerpo"],
}

PROFILE_B = {
    "categoria": [("text_first", ["span.article-head__section__name",
                                  "span.article-head__section__name a.base-link"])],
    "fecha": [("attr_datetime", ["time.article-body__byline__date"])],
    "titulo": [("text_first", ["h1.article-head__title"])],
    "autor": [("text_first", ["a.article-body__byline__author",
                              "span.article-body__byline__authors address"])],
    "abstract": [("text_first", ["h2.article-head__subtitle"])],
    # body rule switches on the category (lower-cased, stripped)
    "cuerpo": {"en vivo": ("body_excluding",
                           ["p.article-body__paragraph, h2.article-body__heading-h2"],
                           ["div.liveblog-entry"]),
               "videos": ("video_body", ["div.article-body__raw-html iframe"]),
               "*": ("body", ["p.article-body__paragraph, h2.article-body__heading-h2"])},
    "cuerpo_en_vivo": {"en vivo": ("live_entries", ["div.liveblog-entry"],
                                   ["time.liveblog-entry__date"],
                                   ["div.liveblog-entry__content h2, "
                                    "div.liveblog-entry__content p"])},
    "imagenes": [("images_captioned", ["figure.article-body__figure"], ["img.global-image"],
                  ["span.article-body__figure__caption"])],
    "videos": [("videos", ["div.article-body__oembed iframe",
                           "div.article-body__oembed-youtube iframe",
                           "div.article-body__raw-html iframe"])],
    "_date_to_spanish": True,
    "_required": ["fecha", "titulo", "cuerpo"],
    "_fecha_optional_for": "en vivo",
    "_cuerpo_or_imagenes": True,
    "_categoria_required": True,
}
# ---- end of fixed values ------------------------------------------------------

# Profile for the driver's ``pages`` table (generic article markup).
PROFILE_G = {
    "titulo": [("text_first", ["article h1"])],
    "cuerpo": [("body_excluding", ["article p"], ["div.ad"])],
    "_required": ["titulo", "cuerpo"],
}

PROFILES = {"A": PROFILE_A, "B": PROFILE_B, "G": PROFILE_G}


#: Outlets up to which their rows are sent to all tasks; a row has a few hundred bytes.
MAX_BROADCAST_SITES = 20_000


def with_outlet(pages: DataFrame, sites: DataFrame, *columns: str) -> DataFrame:
    """``pages`` (with url) plus host, outlet and ``columns`` of the site whose start page has that host.

    Unknown hosts have a null outlet. Few hosts hold many pages each, so their pages stay where
    they are while the (counted) sites are few; a longer list is joined by a shuffle, whose hot
    hosts AQE splits.
    """
    def host(c: str) -> Column:
        return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)", 1))

    known = sites.select(host("start_url").alias("host"), F.col("medio").alias("outlet"), *columns)
    few = known.limit(MAX_BROADCAST_SITES + 1).count() <= MAX_BROADCAST_SITES
    return pages.withColumn("host", host("url")).join(F.broadcast(known) if few else known, "host", "left")


def sites_df(spark: SparkSession) -> DataFrame:
    """D1/D2 as a DataFrame: a handful of rows, safe to broadcast."""
    return spark.createDataFrame(SITES, schemas.SITE_CONFIG)
