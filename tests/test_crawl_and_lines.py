"""References, links by outlet, raw lines, numbered files, exported documents."""
import json
import os
import tempfile
from decimal import ROUND_HALF_UP, Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from newsmetrics import schemas
from newsmetrics.functions import urls
from newsmetrics.functions.jsonfn import decode, decode_reason
from newsmetrics.operators import document as DOC
from newsmetrics.operators import links as K
from newsmetrics.operators import metrics as M
from newsmetrics.plans import catalog_outlets as Q
from newsmetrics.sources import io

BASE = "http://a/b/c/d;p?q"
# ---- fixed values: the examples of RFC 3986, 5.4 (reference, target) -----------------
RFC3986 = """
g:h g:h | g http://a/b/c/g | ./g http://a/b/c/g | g/ http://a/b/c/g/ | /g http://a/g | //g http://g
?y http://a/b/c/d;p?y | g?y http://a/b/c/g?y | #s http://a/b/c/d;p?q#s | g#s http://a/b/c/g#s | g?y#s http://a/b/c/g?y#s
;x http://a/b/c/;x | g;x http://a/b/c/g;x | g;x?y#s http://a/b/c/g;x?y#s | . http://a/b/c/ | ./ http://a/b/c/ | .. http://a/b/
../ http://a/b/ | ../g http://a/b/g | ../.. http://a/ | ../../ http://a/ | ../../g http://a/g | ../../../g http://a/g
../../../../g http://a/g | /./g http://a/g | /../g http://a/g | g. http://a/b/c/g. | .g http://a/b/c/.g | g.. http://a/b/c/g..
..g http://a/b/c/..g | ./../g http://a/b/g | ./g/. http://a/b/c/g/ | g/./h http://a/b/c/g/h | g/../h http://a/b/c/h
g;x=1/./y http://a/b/c/g;x=1/y | g;x=1/../y http://a/b/c/y | g?y/./x http://a/b/c/g?y/./x | g?y/../x http://a/b/c/g?y/../x
g#s/./x http://a/b/c/g#s/./x | g#s/../x http://a/b/c/g#s/../x | http:g http:g
"""
# ---- end of fixed values ------------------------------------------------------------------


def test_references_of_the_rfc(spark):
    pairs = [tuple(p.split()) for line in RFC3986.strip().split("\n") for p in line.split(" | ")] + [("", "http://a/b/c/d;p?q")]
    got = spark.createDataFrame(pairs, "r string, want string").select("*", urls.resolve_reference(F.lit(BASE), "r").alias("got"))
    assert [tuple(r) for r in got.where("got <> want").collect()] == [] and len(pairs) == 42


@pytest.mark.parametrize("base", [BASE, "https://host.example:8080", "https://h/x/y/?a=b#c"])
def test_hrefs_like_the_standard_library(spark, base):
    hrefs = ["/a/../b", "/../b", "/../../b", "/a/./b/.", "/a/..", "/..", "/a//b", "/a//../b", "//h/a/../b?x", "///x/../y", "/a?", "/a#",
             "/a?#", "//h?", "/x?y=/../z#/./q", "/.g/..h/", "/a\n/b", "/a/b;p/../c", "/.", "/", "/a/b/c/../../../../d/./e"]
    got = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", urls.resolve_href(F.lit(base), "h").alias("got"))
    assert {r["h"]: r["got"] for r in got.collect()} == {h: urljoin(base, h) for h in hrefs}
    for h in ("x/y", "../x", "http://q/../x", "", None):  # the others stay as they are
        assert spark.createDataFrame([(h,)], "h string").select(urls.resolve_href(F.lit(base), "h")).first()[0] == h


def test_links_by_the_patterns_of_their_outlet(spark):
    page = "<a href='/noticias/a/b/2024/x'>1</a><a href='/noticia/y'>2</a><a href='/nota/z'>3</a>"
    pages = spark.createDataFrame([(1, "https://www.biobiochile.cl/lista/categorias/x", page), (2, "https://www.latercera.com/canal/x", page),
                                   (3, "https://www.paginado.example/canal/x", page), (4, "https://nadie.example/", page), (5, None, page)],
                                  "page_id long, url string, html string")
    cands, errors = K.outlet_candidates(pages, Q.sites(spark))
    assert {(r["medio"], r["categoria"], r["url"]) for r in cands.collect()} == {
        ("biobiochile", "a/b", "https://www.biobiochile.cl/noticias/a/b/2024/x"), ("latercera", "noticia", "https://www.latercera.com/noticia/y")}
    assert sorted((r["page_id"], r["arg_medio"], r["error_detail"]) for r in errors.collect()) == [
        (4, "https://nadie.example/", "Medio no encontrado en configuraciones"), (5, None, "Medio no encontrado en configuraciones")]


def test_latest_crawl_progress(spark):
    rows = [("a", 1, "running", 3, 1, 100 / 3, 5), ("a", 2, "running", 3, 2, 200 / 3, 6), ("b", 9, "completed", 1, 1, 100.0, 2)]
    p = spark.createDataFrame(rows, "sitio string, page_id long, status string, total_categorias long, categorias_procesadas long, "
                                    "porcentaje double, urls_encontradas long")
    assert sorted(tuple(r) for r in K.latest_crawl_progress(p).collect()) == [("a", "running", 3, 2, 66.7, 6), ("b", "completed", 1, 1, 100.0, 2)]


def test_reasons_of_lines_that_do_not_decode(spark):
    lines = {'{"id_logging_process": 1, "action": "x", "timestamp": null}': None, "{}": None, "": "blank", " \t ": "blank", "{bad": "not JSON",
             "nada": "not JSON", "[1]": "not an object", '"text"': "not an object", "12": "not an object",
             '{"id_logging_process": "x"}': "wrong type", '{"action": "a", "id_logging_process": [1]}': "wrong type", None: "blank"}
    df = spark.createDataFrame([(k,) for k in lines], "value string").withColumn("r", decode("value", schemas.CONTROL_LOG))
    assert {r["value"]: r["why"] for r in df.select("value", decode_reason("value", "r").alias("why")).collect()} == lines
    out = io.decoded_lines(df.drop("r"), schemas.CONTROL_LOG).collect()
    assert sum(r["reason"] is None for r in out) == 2 and all((r["raw"] is None) == (r["reason"] is None) or r["reason"] == "blank" for r in out)
    assert all(r["id_logging_process"] is None for r in out if r["reason"])


def test_numbered_rows_over_files_and_splits(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="nm-csv-"), "crawl")
    n = 3000
    (spark.range(n).repartitionByRange(3, "id").sortWithinPartitions("id").select(F.concat(F.lit("c"), F.col("id") % 5).alias("categoria"),
     F.concat(F.lit("https://x/"), "id").alias("url")).write.csv(path, header=False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # every file is several splits
    try:
        rows = io.read_crawl_csv(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 9
        got = {r["idx"]: r["url"] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i + 1: f"https://x/{i}" for i in range(n)}


def test_rounding_of_the_export(spark):
    """MA2: two, two, three and three places; other columns stay."""
    cols = ["porcentaje_exito", "duracion_segundos", "noticias_por_minuto", "tiempo_promedio_scrape"]
    values = [99.995, 0.005, 12.3456, 1 / 3, 2.675, 1e7 / 3, 0.0, None]
    df = spark.createDataFrame([("m", 7, v, v, v, v) for v in values], "medio string, total long, " + ", ".join(f"{c} double" for c in cols))
    got = M.rounded_for_export(df).collect()

    def rounded(v, places):
        return None if v is None else float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))
    assert [tuple(r) for r in got] == [("m", 7, *(rounded(v, p) for p in (2, 2, 3, 3))) for v in values]


def test_document_omits_parts_without_data(spark):
    part = lambda name, *outlets: spark.createDataFrame([(o, i) for i, o in enumerate(outlets)], f"medio string, {name} long")
    doc = DOC.metrics_document(part("x", "a", "b"), part("y", "b"), part("z", "c"), part("w", "a", "c"))
    got = {r["medio"]: json.loads(r["document"]) for r in DOC.document_json(doc).collect()}
    assert got == {"a": {"scraper_metrics": {"x": 0}, "crawler_progress": {"w": 0}},
                   "b": {"scraper_metrics": {"x": 1}, "scraper_progress": {"y": 0}},
                   "c": {"crawler_metrics": {"z": 0}, "crawler_progress": {"w": 1}}}
