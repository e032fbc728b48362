"""Profiles A and B on inline HTML (the driver's pages hold no such markup)."""

import tempfile

import pytest

from newsmetrics.operators import extract as X
from newsmetrics.operators import html as H
from newsmetrics.sources import io
from newsmetrics.config import PROFILE_A, PROFILE_B


def _articles(spark, docs, profile):
    rows = [(i, f"https://x.example/{i}", "m", profile, h) for i, h in enumerate(docs)]
    pages = spark.createDataFrame(rows, "page_id long, url string, medio string, profile string, "
                                        "html string")
    return {r.page_id: r for r in X.extract_articles(pages).collect()}


A_BODY = ("<div class='post-main'><div class='post-content'><div class='container-redes-contenido'>"
          "<p>Uno</p><h2>Dos</h2><p>Tres</p></div></div></div>")


def test_profile_a_fecha_selectors_and_fallback(spark):
    docs = [
        f"<div class='post-date'>Lunes 10 mayo de 2025</div><h1 class='post-title'>T</h1>{A_BODY}",
        f"<div class='autor-fecha-container'><p class='fecha'>F2</p></div><h1 class='titulo'>T</h1>{A_BODY}",
        f"<div class='nota'><p class='fecha'>F3</p></div><h1 class='titulo'>T</h1>{A_BODY}",
        f"<div class='nota-top-content'><div class='top-content-text'><p class='fecha'>F4</p>"
        f"<h1 class='titular'>T</h1></div></div>{A_BODY}",
        # empty first match moves to the next selector
        f"<div class='post-date'> </div><div class='nota'><p class='fecha'>F5</p></div>"
        f"<h1 class='titulo'>T</h1>{A_BODY}",
        # own text only
        f"<div class='fecha-visitas'><p class='fecha'>Own <span>child</span> text</p></div>"
        f"<h1 class='titulo'>T</h1>{A_BODY}",
    ]
    got = _articles(spark, docs, "A")
    assert [got[i].fecha for i in range(6)] == [
        "Lunes 10 mayo de 2025", "F2", "F3", "F4", "F5", "Own   text"]
    assert all(got[i].status == "success" for i in range(6))
    assert got[0].cuerpo == "Uno\nDos\nTres"
    assert got[0].tipo_multimedia == "imagen"


def test_profile_a_missing_fields_message(spark):
    docs = ["<h1 class='titulo'>T</h1>", "<div class='post-date'>F</div>", "<p>nothing</p>"]
    got = _articles(spark, docs, "A")
    assert got[0].missing == ["fecha", "cuerpo"]
    assert got[0].error == ("Error en el scraping: Faltaron los siguientes parámetros críticos: "
                            "['fecha', 'cuerpo']")
    assert got[1].missing == ["titulo", "cuerpo"]
    assert got[2].missing == ["fecha", "titulo", "cuerpo"] and got[2].status == "error"


def test_profile_a_body_rules(spark):
    head = "<div class='post-date'>F</div><h1 class='titulo'>T</h1>"
    docs = [
        # overlapping selectors: both groups match the same paragraphs -> duplicates
        head + "<div class='container-redes-contenido'><div class='contenido-nota'><p>P</p>"
               "<div class='post-main'></div></div></div>"
               "<div class='post-main'><div class='post-content'><div class='container-redes-contenido'>"
               "<div class='contenido-nota'><p>Q</p></div></div></div></div>",
        # [class^=...] body
        head + "<div class='contenido-nota'><div class='banners-contenido-nota-3 x'><p>B1</p>"
               "<h2>B2</h2></div></div>",
        # one empty paragraph -> '' -> missing cuerpo; two -> '\n' -> valid
        head + "<div class='contenido-nota'><div class='banners-contenido-nota-1'><p></p></div></div>",
        head + "<div class='contenido-nota'><div class='banners-contenido-nota-1'><p></p><p> </p>"
               "</div></div>",
    ]
    got = _articles(spark, docs, "A")
    assert got[0].cuerpo == "Q\nP\nQ"
    assert got[1].cuerpo == "B1\nB2"
    assert got[2].cuerpo == "" and got[2].missing == ["cuerpo"]
    assert got[3].cuerpo == "\n" and got[3].status == "success"


def test_profile_a_images(spark):
    docs = ["<div class='post-date'>F</div><h1 class='titulo'>T</h1>" + A_BODY +
            "<div class='post-main'><div class='post-image'><img src=' /a.jpg '>"
            "<img data-src='/b.jpg'><img data-lazy-src='/a.jpg'></div></div>"
            "<div class='imagen' style=\"background-image: url('/c.jpg')\"></div>"]
    got = _articles(spark, docs, "A")
    assert got[0].multimedia == ["/a.jpg", "/b.jpg", "/c.jpg"]


B_HEAD = ("<span class='article-head__section__name'>{cat}</span>"
          "<h1 class='article-head__title'>Titulo</h1>")


def test_profile_b_normal_live_videos(spark):
    normal = (B_HEAD.format(cat="Política") +
              "<time class='article-body__byline__date' datetime='2025-12-08T09:01:00Z'>x</time>"
              "<p class='article-body__paragraph'>Uno</p>"
              "<figure class='article-body__figure'><img class='global-image' src='i.jpg'>"
              "<span class='article-body__figure__caption'>Cap <b>tion</b></span></figure>"
              "<figure class='article-body__figure'><img class='global-image'></figure>"
              "<figure class='article-body__figure'><img class='global-image' data-src='j.jpg'>"
              "</figure>"
              "<div class='article-body__oembed'><iframe src='//yt.example/v'></iframe></div>")
    live = (B_HEAD.format(cat=" EN VIVO ") +
            "<p class='article-body__paragraph'>Intro</p>"
            "<div class='liveblog-entry'><time class='liveblog-entry__date' datetime='d1'></time>"
            "<div class='liveblog-entry__content'><p>E1</p><h2>H</h2></div>"
            "<p class='article-body__paragraph'>inside</p></div>"
            "<div class='liveblog-entry'><div class='liveblog-entry__content'><p></p></div></div>")
    video = (B_HEAD.format(cat="Videos") +
             "<time class='article-body__byline__date' datetime='2025-05-19'>x</time>"
             "<div class='article-body__raw-html'><iframe src='//v.example/1'></iframe></div>")
    got = _articles(spark, [normal, live, video], "B")
    n, l, v = got[0], got[1], got[2]
    assert n.status == "success" and n.fecha == "Lunes 08 diciembre de 2025"
    assert n.categoria == "Política" and n.cuerpo == "Uno"
    assert [(i.url, i.descripcion) for i in n.imagenes] == [("i.jpg", "Caption"), ("j.jpg", None)]
    assert n.videos == ["https://yt.example/v"]
    assert l.status == "success" and l.fecha is None and l.cuerpo == "Intro"
    assert [(e.fecha, e.cuerpo) for e in l.cuerpo_en_vivo] == [("d1", "E1\nH"), (None, None)]
    assert v.cuerpo == "https://v.example/1" and v.fecha == "Lunes 19 mayo de 2025"
    assert v.videos == ["https://v.example/1"]


def test_profile_b_errors(spark):
    no_cat = ("<h1 class='article-head__title'>T</h1>"
              "<time class='article-body__byline__date' datetime='2025-05-19'>x</time>"
              "<p class='article-body__paragraph'>Uno</p>")
    no_attr = (B_HEAD.format(cat="Mundo") + "<time class='article-body__byline__date'>x</time>"
               "<p class='article-body__paragraph'>Uno</p>")
    img_only = (B_HEAD.format(cat="Mundo") +
                "<time class='article-body__byline__date' datetime='2025-05-19'>x</time>"
                "<figure class='article-body__figure'><img class='global-image' src='i.jpg'></figure>")
    nothing = B_HEAD.format(cat="Mundo")
    got = _articles(spark, [no_cat, no_attr, img_only, nothing], "B")
    assert got[0].status == "error"
    assert got[0].error == "Error en el scraping: 'NoneType' object has no attribute 'lower'"
    assert got[1].error == "Error en el scraping: 'datetime'"
    assert got[2].status == "success" and got[2].cuerpo is None
    assert got[3].missing == ["fecha", "cuerpo"]


def test_tree_keeps_unclosed_p_nesting():
    page = ("<article><h1>T &amp; U</h1><p><b>A<br><p>B</p><p>C</p></article>"
            "<script>var t='</p>';</script><div class='ad'><p>ad</p></div>")
    paragraphs, title, ad = H.scan(page, ["article p", "article h1", "div.ad"])
    assert [p.text(" ") for p in paragraphs] == ["A B C", "B", "C"]
    assert [t.text(" ") for t in title] == ["T & U"] and ad[0].text("") == "ad"
    assert paragraphs[0].number < paragraphs[2].number <= paragraphs[0].last


def test_selector_grammar():
    page = ("<div class='a b'><span class='c'>1</span></div><div class='b'><span>2</span>"
            "</div><p class='pre-x'>3</p>")
    found = H.scan(page, ["div.a.b span, p[class^='pre-']", "span, .c"])
    assert [[m.text("") for m in f] for f in found] == [["1", "3"], ["1", "2"]]
    with pytest.raises(ValueError):
        H.compile_selector("div > p")


def test_anchor_rule():
    page = "<a href='/x'>x</a><a>no</a><!-- <a href='/c'> --><a href='y&amp;z'>y</a>"
    assert X.anchors(page) == ["/x", "y&z"]


def test_odd_pages_become_rows(spark):
    good = "<article><h1>T</h1><p>text</p></article><a href='/x'>x</a>"
    docs = [good, "<article><h1>D</h1>" + "<p>" * 5000 + "deep", "<![foo bar]><h1>x</h1>", None, ""]
    got = _articles(spark, docs, "G")
    assert [got[i].status for i in range(5)] == ["success", "success", "error", "error", "error"]
    assert got[1].titulo == "D" and "AssertionError" in got[2].error and got[2].titulo is None
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(docs)], "page_id long, html string")
    assert [(r.page_id, r.href) for r in X.page_anchors(pages).collect()] == [(0, "/x")]
    assert [r.page_id for r in X.failed_pages(pages).collect()] == [2]


def test_article_records(spark):
    docs = ["<div class='post-date'>F</div><h1 class='titulo'>T</h1>" + A_BODY]
    rows = [(0, "https://x/0", "biobiochile", "A", docs[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, medio string, profile string, "
                                        "html string")
    rec = X.article_a(X.extract_articles(pages))
    assert rec.columns == ["titulo", "fecha", "autor", "desc_autor", "abstract", "cuerpo",
                           "multimedia", "tipo_multimedia", "url"]
    assert rec.count() == 1
    assert X.article_b(X.extract_articles(pages)).count() == 0
    out = tempfile.mkdtemp(prefix="nm-art-")
    io.write_articles(X.article_a(X.extract_articles(pages), outlet=True), out)
    assert [r.medio for r in spark.read.json(out).collect()] == ["biobiochile"]


def test_the_html_step_holds_a_slice_of_a_batch():
    import pyarrow as pa
    page = "<div class='post-main'><div class='post-content'>" + "<p>Uno &amp; dos</p>" * 2_000 + "</div></div>"
    pages = [page] * 90 + [None, ""] + [page * 40] + ["<h1>x</h1>"] * 5_000
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(len(pages))), "profile": ["A"] * len(pages), "html": pages})
    for step, kept in ((X._hit_batches, "hits"), (X._anchor_batches, "hrefs")):
        out = list(step(iter([batch])))
        assert [i for b in out for i in b.column("page_id").to_pylist()] == list(range(len(pages)))
        assert all(kept in b.schema.names and (b.num_rows == 1 or sum(len(pages[i] or "") for i in b.column("page_id").to_pylist()) <= 1 << 20)
                   for b in out)
        assert len(out) > 5 and max(b.num_rows for b in out) <= 1_000
    assert list(X._hit_batches(iter([batch.slice(0, 0)]))) == []
