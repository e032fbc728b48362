"""Metric document and dashboard row (J5, P9-P12, MP1).

All parts are keyed by outlet (a handful of rows each), so the full outer
joins are joins of small tables; AQE sizes them at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: outlet display names ---------------------------------------
DISPLAY_NAMES = {"biobiochile": "BioBio Chile", "latercera": "La Tercera"}
# ---- end of fixed values --------------------------------------------------------


def display_name(c) -> F.Column:
    """Outlet code -> display name; unknown codes pass through."""
    c = F.col(c) if isinstance(c, str) else c
    out = c
    for k, v in DISPLAY_NAMES.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def _prefixed(df: DataFrame | None, prefix: str) -> DataFrame | None:
    if df is None:
        return None
    return df.select("medio", *[F.col(c).alias(prefix + c) for c in df.columns if c != "medio"])


def metrics_document(scraper_metrics: DataFrame | None, scraper_progress: DataFrame | None,
                     crawler_metrics: DataFrame | None, crawler_progress: DataFrame | None = None) -> DataFrame:
    """Per-outlet document row, each of four parts present only when it has data.

    Full outer join on medio of the per-outlet parts; a part that is absent
    for an outlet stays null (dropped by ``to_json``).
    """
    parts = [p for p in (_prefixed(scraper_metrics, "m_"), _prefixed(scraper_progress, "p_"),
                         _prefixed(crawler_metrics, "c_"), _prefixed(crawler_progress, "g_")) if p is not None]
    doc = parts[0]
    for p in parts[1:]:
        doc = doc.join(p, "medio", "full_outer")
    return doc


def document_json(doc: DataFrame) -> DataFrame:
    """P9 export: one JSON text per outlet; a part with no data is omitted."""
    def part(prefix):
        cols = [c for c in doc.columns if c.startswith(prefix)]
        if not cols:
            return F.lit(None)
        present = F.greatest(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1 \
            else F.col(cols[0]).isNotNull()
        return F.when(present, F.struct(*[F.col(c).alias(c[len(prefix):]) for c in cols]))
    return doc.select("medio", F.to_json(F.struct(
        part("m_").alias("scraper_metrics"), part("p_").alias("scraper_progress"),
        part("c_").alias("crawler_metrics"), part("g_").alias("crawler_progress"))).alias("document"))


def active_outlet(crawl_progress_sitio: DataFrame, outlets: DataFrame) -> DataFrame:
    """Crawl-progress ``sitio`` if any, else the first outlet (min, deterministic).

    One global aggregate over a union of the two small inputs (no join).
    """
    a = crawl_progress_sitio.select(F.col("sitio").alias("__s"), F.lit(None).cast("string").alias("__m"))
    b = outlets.select(F.lit(None).cast("string").alias("__s"), F.col("medio").alias("__m"))
    g = a.unionByName(b).agg(F.max("__s").alias("__s"), F.min("__m").alias("__m"))
    return g.select(F.coalesce("__s", "__m").alias("medio_activo"))


def dashboard_row(progress: DataFrame, active: DataFrame) -> DataFrame:
    """P10: the dashboard's numbers for the active outlet, missing numbers as 0.

    ``progress`` is the live progress (one row per outlet); ``active`` is one
    row. Semi-join by outlet keeps one row; rate formatted to one decimal.
    """
    p = progress.join(active.withColumnRenamed("medio_activo", "medio"), "medio", "inner")
    return p.select(
        "medio", display_name("medio").alias("medio_nombre"),
        F.coalesce("total_articulos_exitosos", F.lit(0)).cast("long").alias("exitosos"),
        F.coalesce("total_articulos_fallidos", F.lit(0)).cast("long").alias("fallidos"),
        F.format_string("%.1f", F.coalesce("articulos_por_minuto", F.lit(0.0))).alias("tasa_txt"),
        "articulos_por_minuto",
        F.current_timestamp().alias("timestamp"))


def dashboard_document(doc: DataFrame) -> DataFrame:
    """P10: one row per outlet with the numbers of all four parts; missing numbers are 0, rates have one decimal.

    ``doc`` is a ``metrics_document`` with its four parts.
    """
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    rate = lambda c: F.format_string("%.1f", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    return doc.select(
        "medio", display_name("medio").alias("medio_nombre"), F.coalesce("g_status", F.lit("")).alias("estado"),
        rate("g_porcentaje").alias("porcentaje"), number("g_categorias_procesadas").alias("categorias"),
        number("g_total_categorias").alias("total_categorias"), number("g_urls_encontradas").alias("urls"),
        number("c_total_urls_encontradas").alias("urls_final"), rate("c_urls_por_minuto").alias("urls_por_minuto"),
        number("p_total_articulos_exitosos").alias("exitosos"), number("p_total_articulos_fallidos").alias("fallidos"),
        rate("p_articulos_por_minuto").alias("tasa"), number("m_total_urls_procesadas").alias("procesadas"),
        rate("m_porcentaje_exito").alias("porcentaje_exito"))
