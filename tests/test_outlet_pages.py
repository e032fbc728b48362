"""The rendered outlet pages hold every arm of profiles A and B (J6, X1-X10, X13-X15, F7-F9, P6-P8, DT2)."""
import itertools
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsmetrics import config
from newsmetrics.functions.dates import DIAS_ES, MESES_ES, iso_to_spanish
from newsmetrics.operators import extract as X
from newsmetrics.plans import outlet_pages as OP
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def articles(spark):
    pages = OP.outlet_pages(spark, SF_CHECK)
    return X.extract_outlet_pages(pages, config.sites_df(spark)).cache()


def test_every_arm_occurs(articles):
    arms = {
        "A ok": "profile = 'A' AND status = 'success'", "B ok": "profile = 'B' AND status = 'success'",
        "no date": "array_contains(missing, 'fecha') AND profile = 'A'", "no date in B": "array_contains(missing, 'fecha') AND profile = 'B'",
        "no title": "array_contains(missing, 'titulo')", "no body": "array_contains(missing, 'cuerpo') AND profile = 'B'",
        "body of images": "profile = 'B' AND coalesce(cuerpo, '') = '' AND status = 'success'",
        "several missing": "size(missing) > 1", "live without date": "categoria = 'EN VIVO' AND fecha IS NULL AND status = 'success'",
        "live entries": "size(cuerpo_en_vivo) = 2 AND cuerpo_en_vivo[1].fecha IS NULL AND cuerpo_en_vivo[0].cuerpo LIKE 'Hora%'",
        "video body": "categoria = 'Videos' AND cuerpo LIKE 'https://v.example/%'", "no category": "error LIKE '%NoneType%'",
        "no datetime": "error LIKE '%''datetime''%'", "no source": "error LIKE '%''src''%'", "unknown outlet": "medio = 'www.otro.example'",
        "bad date kept": "fecha = '2020-13-45'", "spanish date": "profile = 'B' AND fecha LIKE '% de 202%'",
        "caption": "imagenes[0].descripcion LIKE 'Piedefoto%'", "no caption": "imagenes[0].descripcion IS NULL AND size(imagenes) = 1",
        "background": "multimedia[0] LIKE '/c%'", "distinct images": "size(multimedia) = 2", "no images": "profile = 'A' AND multimedia IS NULL",
        "videos": "videos[0] LIKE 'https://yt.%'", "lazy video": "videos[0] LIKE 'https://yt2%'",
        "own text date": "profile = 'A' AND fecha IS NOT NULL AND page_id div 2 % 7 = 5", "piped date": "fecha LIKE '%| 10:30'"}
    n = articles.agg(*[F.count_if(F.expr(e)).alias(a) for a, e in arms.items()]).first().asDict()
    assert min(n.values()) >= 3, n


def test_records_of_both_outlets(articles):
    a, b = X.article_a(articles), X.article_b(articles)
    ok = articles.where("status = 'success'").groupBy("profile").count().collect()
    assert {r["profile"]: r["count"] for r in ok} == {"A": a.count(), "B": b.count()}
    assert "tipo_multimedia" in a.columns and "imagenes" in b.columns


def spanish(d):
    return f"{DIAS_ES[d.weekday()]} {d.day:02d} {MESES_ES[d.month - 1]} de {d.year}"


def python_date(value):
    """DT2 with the standard library."""
    try:
        if "T" in value:
            return spanish(datetime.fromisoformat(value.replace("Z", "+00:00") if value.endswith("Z") else value).date())
        return spanish(datetime.strptime(value, "%Y-%m-%d").date())
    except ValueError:
        return value


def test_iso_week_dates(spark):
    values = [f"{y}{a}W{w:02d}{b}{d}{t}" for y, w, d, t in itertools.product(
        (2015, 2016, 2020, 2021, 2026), (0, 1, 8, 9, 52, 53, 54), ("", 1, 5, 7, 8), ("T10:00:00", "T10:00:00Z", ""))
        for a, b in (("-", "-" if d else ""), ("", ""))]
    values += ["2020-W53-5T10", "20200229T101112", "20210229T101112", "2020-W1-5T10:00", "2020W53-5T10:00", "2020-W535T10:00", "2020-W53T10:00:00"]
    got = {r["v"]: r["s"] for r in spark.createDataFrame([(v,) for v in values], "v string").select("v", iso_to_spanish("v").alias("s")).collect()}
    wrong = {v: (got[v], python_date(v)) for v in values if got[v] != python_date(v)}
    assert wrong == {}
    assert got["2020-W53-5T10:00:00Z"] == spanish(date(2021, 1, 1))
