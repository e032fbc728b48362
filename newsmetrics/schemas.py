"""Fixed schemas for every record type of the pipeline.

Logs travel as all-string JSON; typed views are derived from them with
``try_*`` functions so that bad values are skipped, never fatal.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# D1 + D2: site config with its extraction profile
SITE_CONFIG = _struct(
    ("medio", S), ("start_url", S), ("category_pattern", S),
    ("news_pattern", T.ArrayType(S)), ("pagination_type", S),
    ("load_more_selector", S), ("max_clicks", L), ("profile", S),
)

# D3 / D4 / D15
CATEGORY_LINK = _struct(("medio", S), ("category_url", S))
NEWS_LINK = _struct(("medio", S), ("categoria", S), ("url", S))
CRAWL_CSV = _struct(("categoria", S), ("url", S))

# D5 URL task message (tags may arrive as a JSON array in text form)
URL_TASK = _struct(("url", S), ("tags", S), ("medio", S))

# D6 article, profile A
ARTICLE_A = _struct(
    ("titulo", S), ("fecha", S), ("autor", S), ("desc_autor", S), ("abstract", S),
    ("cuerpo", S), ("multimedia", T.ArrayType(S)), ("tipo_multimedia", S), ("url", S),
)

LIVE_ENTRY = _struct(("fecha", S), ("cuerpo", S))
IMAGE = _struct(("url", S), ("descripcion", S))

# D7 article, profile B
ARTICLE_B = _struct(
    ("categoria", S), ("titulo", S), ("fecha", S), ("autor", S), ("abstract", S),
    ("cuerpo", S), ("cuerpo_en_vivo", T.ArrayType(LIVE_ENTRY)),
    ("imagenes", T.ArrayType(IMAGE)), ("videos", T.ArrayType(S)), ("url", S),
)

# D8 scrape-result log, raw (strings as on the wire); arrival_seq is ours
SCRAPE_LOG_RAW = _struct(
    ("arrival_seq", L), ("url", S), ("medio", S), ("starting_time", S), ("status", S),
    ("fecha_publicacion", S), ("finishing_time", S), ("duration_ms", S), ("error", S),
    ("id_logging_process", L),
)

# D9 error log
ERROR_LOG = _struct(
    ("from", S), ("arg_medio", S), ("error_timestamp", S), ("stage", S),
    ("error_detail", S), ("id_logging_process", L),
)

# D10 control log
CONTROL_LOG = _struct(("id_logging_process", L), ("action", S), ("timestamp", S))

# D11 crawl progress
CRAWL_PROGRESS = _struct(
    ("sitio", S), ("status", S), ("total_categorias", L), ("categorias_procesadas", L),
    ("porcentaje", D), ("urls_encontradas", L),
)

# D12 crawl metrics value (snapshot is a map medio -> value)
CRAWL_METRICS_VALUE = _struct(
    ("total_categorias", L), ("total_urls_encontradas", L), ("urls_por_categoria", D),
    ("duracion_segundos", D), ("urls_por_minuto", D),
)

# D13 scrape progress value
SCRAPE_PROGRESS_VALUE = _struct(
    ("total_articulos_exitosos", L), ("total_articulos_fallidos", L),
    ("duracion_promedio_ms", D), ("articulos_por_minuto", D),
    ("ultima_actualizacion", S), ("start_time", S),
)

# D14 scrape metrics value
SCRAPE_METRICS_VALUE = _struct(
    ("total_urls_procesadas", L), ("scrape_exitosos", L), ("scrape_fallidos", L),
    ("porcentaje_exito", D), ("duracion_segundos", D), ("noticias_por_minuto", D),
    ("tiempo_promedio_scrape", D), ("publicaciones_por_fecha", T.MapType(S, L)),
)

# Row forms (keyed by medio) used inside the engine
SCRAPE_PROGRESS = T.StructType([T.StructField("medio", S)] + SCRAPE_PROGRESS_VALUE.fields)
CRAWL_METRICS = T.StructType([T.StructField("medio", S)] + CRAWL_METRICS_VALUE.fields)

# Output of page extraction (one row per page), before validation
EXTRACTED = _struct(
    ("page_id", L), ("url", S), ("medio", S), ("profile", S),
    ("categoria", S), ("titulo", S), ("fecha", S), ("autor", S), ("desc_autor", S),
    ("abstract", S), ("cuerpo", S), ("cuerpo_en_vivo", T.ArrayType(LIVE_ENTRY)),
    ("multimedia", T.ArrayType(S)), ("imagenes", T.ArrayType(IMAGE)),
    ("videos", T.ArrayType(S)), ("error", S),
)
