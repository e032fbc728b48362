"""Crawl operators over the page table.

A page is a category page of the outlet named by its host. Anchors come from
the one HTML step (``extract.page_anchors``); everything after is Spark SQL:
resolution (STR3), pattern filters (F1/F2), category tags (STR1/STR2), dedup
(U1-U3) and crawl metrics (A13, W1). Dedups are partial+final aggregates, so
a link that appears on every page (navigation) is collapsed map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import urls
from . import extract, windows
from .progress import crawl_progress_pct

_HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)"
_FIRST_SEG_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)"


def category_pages(pages: DataFrame) -> DataFrame:
    """Pages as category pages: medio = host (or the page's own medio), slug = first path segment."""
    own = F.col("medio") if "medio" in pages.columns else F.lower(F.regexp_extract("url", _HOST_RE, 1))
    return pages.select(
        "page_id", "html", own.alias("medio"),
        F.col("url").alias("category_url"),
        F.regexp_extract("url", _FIRST_SEG_RE, 1).alias("slug"))


def resolved_links(pages: DataFrame) -> DataFrame:
    """X12 + F3 + STR3: (page_id, medio, category_url, slug, pos, href, link)."""
    cp = category_pages(pages)
    a = extract.page_anchors(cp.select("page_id", F.col("category_url").alias("url"), "html",
                                       "medio", "slug"))
    return a.select("page_id", "medio", F.col("url").alias("category_url"), "slug", "pos",
                    "href", urls.resolve_href(F.col("url"), F.col("href")).alias("link"))


def category_links(links: DataFrame, category_pattern: str) -> DataFrame:
    """Distinct category links per outlet."""
    return (links.filter(urls.contains_pattern("link", category_pattern))
            .select("medio", F.col("link").alias("category_url")).distinct())


def news_candidates(links: DataFrame, news_pattern: list[str],
                    pagination_type: str = "loadmore") -> DataFrame:
    """X17 / F2 / F15 / STR1: news links with their category tag, per category page.

    Distinct within a page (the reference keeps a set per category page).
    Only the ``loadmore`` pagination mode yields links (F15).
    """
    pats = F.array(*[F.lit(p) for p in news_pattern])
    if pagination_type != "loadmore":
        return links.limit(0).select("medio", "page_id", "category_url",
                                     F.lit(None).cast("string").alias("categoria"),
                                     F.col("link").alias("url"))
    hits = links.filter(urls.matches_any("link", pats))
    return (urls.add_category(hits, "link", "slug", "categoria")
            .select("medio", "page_id", "category_url", "categoria", F.col("link").alias("url"))
            .distinct())


def outlet_candidates(pages: DataFrame, sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """News links of category pages by the patterns of their own outlet.

    ``pages``: page_id, url, html; ``sites``: D1 rows, found by the host of their start page. The
    outlet's row joins each link once, so a link is compared with its own outlet's patterns only,
    however many outlets there are. Pages of unknown hosts and of outlets whose pagination is
    not ``loadmore`` give no links. Second result: one error record per page of an unknown host.
    """
    cp = config.with_outlet(pages.select("page_id", "url", "html"), sites, "category_pattern", "news_pattern", "pagination_type")
    errors = cp.where(F.col("outlet").isNull()).select(
        F.lit("crawler").alias("origen"), F.col("url").alias("arg_medio"), F.lit("crawl_news").alias("etapa"),
        F.lit(extract.UNKNOWN_OUTLET).alias("error_detail"), "page_id")
    anchors = extract.page_anchors(cp.where(F.col("outlet").isNotNull() & (F.col("pagination_type") == "loadmore"))
                                   .select("page_id", "url", "html", F.col("outlet").alias("medio"), "category_pattern", "news_pattern"))
    links = anchors.select("page_id", "medio", F.col("url").alias("category_url"), urls.category_slug("url").alias("slug"),
                           "news_pattern", urls.resolve_href("url", "href").alias("link"))
    hits = links.where(urls.matches_any("link", "news_pattern"))
    return (urls.add_category(hits, "link", "slug", "categoria")
            .select("medio", "page_id", "category_url", "categoria", F.col("link").alias("url")).distinct(), errors)


def news_links(cands: DataFrame) -> DataFrame:
    """Distinct (medio, categoria, url) pairs over all categories."""
    return cands.select("medio", "categoria", "url").distinct()


def first_seen(cands: DataFrame) -> DataFrame:
    """The first category that found each url wins (one task per url).

    Processing order is page order (page_id), then category tag. A
    ``min_by`` aggregate, so a url found on every page collapses map-side.
    """
    first = F.min_by(F.struct("page_id", "categoria"), F.struct("page_id", "categoria"))
    return (cands.groupBy("medio", "url").agg(first.alias("f"))
            .select("url", F.col("f.categoria").alias("tags"), "medio"))


def crawl_metrics(pages: DataFrame, cands: DataFrame, duration_s: float = 0.0) -> DataFrame:
    """A13 / MA1: categories, distinct (categoria, url) pairs, urls/category, urls/min.

    Both counts are exact distinct counts done as two partial+final
    aggregations combined by a union and one more aggregation (no join).
    """
    cats = category_pages(pages).select("medio", "category_url").distinct() \
        .select("medio", F.lit(1).cast("long").alias("c"), F.lit(0).cast("long").alias("u"))
    pairs = news_links(cands).select("medio", F.lit(0).cast("long").alias("c"),
                                     F.lit(1).cast("long").alias("u"))
    g = cats.unionByName(pairs).groupBy("medio").agg(
        F.sum("c").alias("total_categorias"), F.sum("u").alias("total_urls_encontradas"))
    dur = F.lit(float(duration_s))
    return g.select(
        "medio", "total_categorias", "total_urls_encontradas",
        F.when(F.col("total_categorias") > 0,
               F.col("total_urls_encontradas") / F.col("total_categorias"))
         .otherwise(F.lit(0.0)).alias("urls_por_categoria"),
        dur.alias("duracion_segundos"),
        F.when(dur > 0, F.col("total_urls_encontradas") / (dur / 60.0))
         .otherwise(F.lit(0.0)).alias("urls_por_minuto"))


def crawl_progress(pages: DataFrame, cands: DataFrame, block_size: int = 1 << 16) -> DataFrame:
    """Progress snapshot after each category page, in page order.

    A pair is new at the first page (lowest page_id) that found it; new pairs
    per page are summed in page order with the blocked running sum, so a large
    outlet is not one window partition.
    """
    pg = category_pages(pages).select("medio", "page_id").distinct()
    first = (news_links_with_page(cands).groupBy("medio", "categoria", "url")
             .agg(F.min("page_id").alias("page_id")))
    new_per_page = first.groupBy("medio", "page_id").agg(F.count(F.lit(1)).alias("n_new"))
    base = (pg.join(new_per_page, ["medio", "page_id"], "left")
            .select("medio", "page_id", F.coalesce("n_new", F.lit(0)).cast("long").alias("n_new"),
                    F.lit(1).cast("long").alias("one")))
    run = windows.running_sums(base, keys=["medio"], order="page_id",
                               sums={"categorias_procesadas": "one",
                                     "urls_encontradas": "n_new"},
                               block_size=block_size)
    totals = pg.groupBy("medio").agg(F.count(F.lit(1)).cast("long").alias("total_categorias"))
    r = run.join(totals, "medio")
    done, total = F.col("categorias_procesadas"), F.col("total_categorias")
    return r.select(
        F.col("medio").alias("sitio"), "page_id",
        F.when(done == total, F.lit("completed")).otherwise(F.lit("running")).alias("status"),
        total.alias("total_categorias"), done.cast("long").alias("categorias_procesadas"),
        crawl_progress_pct(done, total).alias("porcentaje"),
        F.col("urls_encontradas").cast("long").alias("urls_encontradas"))


def latest_crawl_progress(progress: DataFrame) -> DataFrame:
    """K7: the snapshot after each outlet's last page, as the progress file holds it (percentage to one place)."""
    cols = [c for c in progress.columns if c not in ("sitio", "page_id")]
    last = progress.groupBy("sitio").agg(F.max_by(F.struct(*cols), "page_id").alias("p"))
    return last.select(F.col("sitio").alias("medio"), *[
        (F.round(F.col("p")[c], 1) if c == "porcentaje" else F.col("p")[c]).alias(c) for c in cols])


def news_links_with_page(cands: DataFrame) -> DataFrame:
    return cands.select("medio", "page_id", "categoria", "url")


def with_site_config(links: DataFrame, sites: DataFrame) -> DataFrame:
    """Attach outlet config (broadcast: one row per configured outlet).

    Rows of unknown outlets get ``config_error`` (the reference raises and
    logs); they are kept, not dropped.
    """
    s = sites.select("medio", "category_pattern", "news_pattern", "pagination_type", "profile")
    j = links.join(F.broadcast(s), "medio", "left")
    return j.withColumn("config_error", F.when(F.col("profile").isNull(),
                                               F.lit(extract.UNKNOWN_OUTLET)))
