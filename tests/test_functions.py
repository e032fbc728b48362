"""Column expressions against tables of input and expected output, and properties."""

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsmetrics.functions import dates, text, urls

# written form of a publication date -> normalised form, worked out from the rules of SURVEY 2.12
DATES = [
    ('Lunes 10 mayo de 2025', 'Lunes 10 mayo de 2025'),
    ('Lunes 10 mayo de 2025 | 10:30', 'Lunes 10 mayo de 2025'),
    ('2025-05-19T21:22:48.24Z', 'Lunes 19 mayo de 2025'),
    ('2025-05-19T23:30:00-03:00', 'Lunes 19 mayo de 2025'),
    ('2025-05-19T21:22:48', '2025-05-19T21:22:48'),
    ('2025-05-19', 'Lunes 19 mayo de 2025'),
    ('2025-1-5', 'Domingo 05 enero de 2025'),
    ('19-05-2025', 'Lunes 19 mayo de 2025'),
    ('19/05/2025', 'Lunes 19 mayo de 2025'),
    ('2025/05/19', 'Lunes 19 mayo de 2025'),
    ('Jueves 18 Diciembre, 2025', 'Jueves 18 Diciembre, 2025'),
    ('Thursday 11 December de 2025', 'Thursday 11 December de 2025'),
    ('', None),
    ('   ', None),
    (None, None),
    ('2025-02-30', '2025-02-30'),
    ('31/04/2025', '31/04/2025'),
    ('2025-05-19T23:59:59+05:00', 'Lunes 19 mayo de 2025'),
    ('2025-12-31T23:30:00Z', 'Miércoles 31 diciembre de 2025'),
    (' 2025-05-19 ', 'Lunes 19 mayo de 2025'),
    ('2025/5/9 | x', 'Viernes 09 mayo de 2025'),
    ('2025-05-19T25:00:00Z', '2025-05-19T25:00:00Z'),
    ('T-', 'T-'),
    ('2025-05-19Tab-1', '2025-05-19Tab-1'),
    ('12-1-2024', 'Viernes 12 enero de 2024'),
    ('2024-13-01', '2024-13-01'),
]


ISO = [
    ('2025-12-08T09:01:00Z', 'Lunes 08 diciembre de 2025'),
    ('2025-05-19T21:22:48.24+00:00', 'Lunes 19 mayo de 2025'),
    ('2025-05-19', 'Lunes 19 mayo de 2025'),
    ('19/05/2025', '19/05/2025'),
    ('', ''),
    (None, None),
    ('nonsense', 'nonsense'),
    ('2025-05-19T23:30:00-03:00', 'Lunes 19 mayo de 2025'),
    ('2025-02-30T10:00:00Z', '2025-02-30T10:00:00Z'),
]


def _run(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    rows = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def _run_staged(spark, values, add):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in add(df, "v", "o").orderBy("i").collect()]


def test_normalize_pub_date_edges(spark):
    values, want = map(list, zip(*DATES))
    assert _run(spark, values, dates.normalize_pub_date) == want
    assert _run_staged(spark, values, dates.add_pub_date) == want


def test_iso_to_spanish_edges(spark):
    values, want = map(list, zip(*ISO))
    assert _run(spark, values, dates.iso_to_spanish) == want
    assert _run_staged(spark, values, dates.add_iso_to_spanish) == want


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago", "Asia/Kolkata"])
def test_parse_log_time(spark, zone):
    good = datetime(2025, 1, 5, 3, 4, 5)
    table = [("2025-01-05 03:04:05", good), ("2025-1-5 3:4:5", good), ("2025-01-05  03:04:05", good),
             ("2025-09-07 00:30:00", datetime(2025, 9, 7, 0, 30)), ("0001-01-01 00:00:00", datetime(1, 1, 1))]
    table += [(v, None) for v in ("", None, "abc", "2025-02-30 10:00:00", "2025-01-05 03:04",
                                  "2025-01-05 03:04:60", "2025-01-05T03:04:05")]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert _run(spark, [v for v, _ in table], dates.parse_log_time) == [w for _, w in table]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_spanish_date_weekdays(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2025-05-12', DATE'2025-05-18')) AS d")
    got = [r.o for r in df.select(dates.spanish_date("d").alias("o")).orderBy("d").collect()]
    assert got[0] == "Lunes 12 mayo de 2025" and got[-1] == "Domingo 18 mayo de 2025"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.dates(), min_size=1, max_size=20),
       st.sampled_from(["%Y-%m-%d", "%d-%m-%Y", "%d/%m/%Y", "%Y/%m/%d",
                        "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%f-03:00"]))
def test_every_written_form_names_its_day(spark, days, form):
    def written(d):
        return d.strftime(form.replace("%Y", f"{d.year:04d}"))
    got = _run_staged(spark, [written(d) for d in days], dates.add_pub_date)
    plain = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    assert got == [r.o for r in plain.select("i", dates.spanish_date("d").alias("o")).orderBy("i").collect()]


# link, slug of the page it was found on, category by the rules of SURVEY 2.11
LINKS = [
    ('https://www.biobiochile.cl/noticias/nacional/chile/2025/10/12/x.shtml', 's', 'nacional/chile'),
    ('https://www.biobiochile.cl/especial/bio-bio-tuercas/noticias/2025/10/31/x.shtml', 's', 'bio-bio-tuercas'),
    ('https://www.biobiochile.cl/especial/bbcl-investiga/noticias/entrevistas/2025/11/01/x.shtml', 's', 'bbcl-investiga/entrevistas'),
    ('https://www.biobiochile.cl/especial/bbcl-investiga/noticias/de-pasillo/2025/10/30/x.shtml', 's', 'bbcl-investiga/de-pasillo'),
    ('https://www.biobiochile.cl/noticias/dopamina/2025/10/30/x.shtml', 's', 'dopamina'),
    ('https://www.biobiochile.cl/noticias/servicios/beneficios/2025/10/23/x.shtml', 'slug', 'servicios/beneficios'),
    ('https://www.biobiochile.cl/noticias-patrocinadas/a/b', 'slug', 'slug'),
    ('https://www.biobiochile.cl/noticias/noticias-patrocinadas/2025/x', 'slug', 'noticias-patrocinadas'),
    ('https://www.biobiochile.cl/noticias/biobiochile/noticias/a/b/c', 'slug', 'noticias/a'),
    ('https://www.biobiochile.cl/lista/categorias/nacional', 'nacional', 'nacional'),
    ('https://www.biobiochile.cl/noticias/', 'slug', 'slug'),
    ('https://www.latercera.com/politica/noticia/exministro/', '', 'politica'),
    ('https://www.latercera.com/', '', 'sin-categoria'),
    ('https://www.latercera.com/videos/noticia/desde-la-redaccion/', '', 'videos'),
    ('https://other.example/noticias/a/b', 'en', 'en'),
    ('//www.biobiochile.cl/noticias/a/2024/x', '', 'a'),
]


def test_category_rules(spark):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(LINKS)], "i int, link string, slug string, want string")
    want = [w for *_, w in LINKS]
    assert [r.o for r in df.select("i", urls.category("link", "slug").alias("o")).orderBy("i").collect()] == want
    assert [r.o for r in urls.add_category(df, "link", "slug", "o").orderBy("i").collect()] == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["noticias", "especial", "biobiochile", "2025", "10", "nacional", "", "Noticias",
     "noticias-patrocinadas", "x.shtml", "1999", "a"]), max_size=7), min_size=1, max_size=10),
    st.sampled_from(["https://www.biobiochile.cl/", "https://www.latercera.com/", "http://x.org/"]))
def test_category_properties(spark, paths, host):
    links = [(i, host + "/".join(p), "slug") for i, p in enumerate(paths)]
    df = spark.createDataFrame(links, "i int, link string, slug string")
    got = [r.o for r in df.select("i", urls.category("link", "slug").alias("o")).orderBy("i").collect()]
    assert [r.o for r in urls.add_category(df, "link", "slug", "o").orderBy("i").collect()] == got
    for path, category in zip(paths, got):
        parts = [p for p in path if p]
        if "x.org" in host:
            assert category == "slug"
        elif "latercera" in host:
            assert category == (parts[0] if parts else "sin-categoria")
        else:
            tags = category.split("/")
            assert len(tags) <= 3 and (category == "slug" or set(tags) <= set(parts))
            assert not any(t.isdigit() and len(t) == 4 for t in tags)


def test_resolve_and_slug(spark):
    from urllib.parse import urljoin
    rows = [("https://a.example/en/1?x=1", "/the"), ("http://b.example:8080/p", "//c.example/q"),
            ("https://a.example/en/1", "rel/path"), ("https://a.example/en/1", "https://z/x"),
            ("https://a.example", "/x?y#z")]
    df = spark.createDataFrame(rows, "base string, href string")
    got = [r.o for r in df.select(urls.resolve_href("base", "href").alias("o")).collect()]
    want = [urljoin(b, h) if h.startswith("/") else h for b, h in rows]
    assert got == want
    s = spark.createDataFrame([("https://www.biobiochile.cl/lista/categorias/nacional/",),
                               ("https://www.latercera.com/canal/politica/",)], "u string")
    assert [r.o for r in s.select(urls.category_slug("u").alias("o")).collect()] == ["nacional", ""]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a | b ", "background-image: url('x.jpg')", "//v.example/1")],
                               "a string, s string, v string")
    r = df.select(text.before_pipe("a").alias("p"), text.css_background_url("s").alias("c"),
                  text.https_prefix("v").alias("h"), text.lower_trim(F.lit(" En Vivo ")).alias("l"),
                  text.py_strip(F.lit(" x\t")).alias("ps")).first()
    assert (r.p, r.c, r.h, r.l, r.ps) == ("a", "x.jpg", "https://v.example/1", "en vivo", "x")


def test_matches_any(spark):
    df = spark.createDataFrame([("https://x/noticias/1", ["/noticia/", "/noticias/"]),
                                ("https://x/canal/1", ["/noticia/"])], "u string, p array<string>")
    assert [r.o for r in df.select(urls.matches_any("u", "p").alias("o")).collect()] == [True, False]
