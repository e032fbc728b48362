"""Article and anchor extraction over the page table (X1-X15, UD1, UD2, J6).

The only Python step is one ``mapInArrow`` in which a single pass over each page
records its pieces of text, once, and per selector of the page's profile the matching
elements: place, first and last piece, attributes. A page that the parser can't read becomes
a row with its error. What a rule makes of the matches - first non-empty text, captions inside a
figure, bodies outside a block - is Spark SQL over that array, as are validation
F7-F9, outcome X15, error text P8, date conversion DT2 and image dedup U4.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config, schemas
from ..functions import dates, text
from . import html as H

SLICE_BYTES, SLICE_PAGES = 1 << 20, 1_000  # of HTML that a task works on at a time
ATTRIBUTES = ("datetime", "src", "data-src", "data-lazy-src", "style")
_NUMBERS = ("pick", "number", "last", "begin", "end")
HITS = T.ArrayType(T.StructType(
    [T.StructField(n, T.IntegerType()) for n in _NUMBERS] + [T.StructField("own", T.StringType())]
    + [T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))]))
_HITS_ARROW = pa.list_(pa.struct([pa.field(n, pa.int32()) for n in _NUMBERS] + [
    pa.field("own", pa.string()), pa.field("attrs", pa.map_(pa.string(), pa.string()))]))
IMAGE_SOURCES, VIDEO_SOURCES = ("src", "data-src", "data-lazy-src"), ("src", "data-src")
NO_CATEGORY = "'NoneType' object has no attribute 'lower'"
FIELDS = ["categoria", "titulo", "fecha", "autor", "desc_autor", "abstract", "cuerpo",
          "cuerpo_en_vivo", "multimedia", "imagenes", "videos"]


# ------------------------------------------------------------------ the HTML step
def rules_of(profile: dict) -> list[tuple]:
    """All (kind, selector lists...) rules of a profile."""
    out = []
    for field, rule in profile.items():
        if not field.startswith("_"):
            out += list(rule.values()) if isinstance(rule, dict) else rule
    return out


def selectors_of(profile: dict) -> list[str]:
    """The profile's selectors, each once; a match's ``pick`` is its place here."""
    return list(dict.fromkeys(s for _, *groups in rules_of(profile) for g in groups for s in g))


def page_hits(html: str | None, selectors: list[str], own: frozenset[int] = frozenset()) -> tuple[list[dict], list[str]]:
    """Matches of all selectors and the page's pieces of text; a match's text is the pieces ``begin`` to ``end``.

    ``own`` numbers the selectors whose matches need the text directly in them.
    """
    found, pieces = H.scan_pieces(html, selectors)
    return [{"pick": k, "number": m.number, "last": m.last, "begin": m.begin, "end": m.end,
             "own": m.own_text() if k in own else None, "attrs": [(a, m.attrs[a]) for a in ATTRIBUTES if a in m.attrs]}
            for k, matches in enumerate(found) for m in matches], pieces


def anchors(html: str | None) -> list[str]:
    """Href of every ``a`` element that has one, in document order."""
    return [m.attrs["href"] for m in H.scan(html, ["a[href]"])[0]]


def _failure(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def own_text_selectors(profile: dict) -> frozenset[int]:
    place = selectors_of(profile)
    return frozenset(place.index(s) for kind, *groups in rules_of(profile) if kind == "own_text_first" for g in groups for s in g)


def _page_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about SLICE_BYTES of HTML, or one page.

    What the parser finds takes many times a page's bytes, so a task holds the finds of one slice and not of a batch.
    """
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column("html")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            end = min(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), at + SLICE_PAGES)
            end = min(max(end, at + 1), b.num_rows)
            yield b.slice(at, end - at)
            at = end


def _hit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted = {name: (selectors_of(p), own_text_selectors(p)) for name, p in config.PROFILES.items()}
    for b in _page_slices(batches):
        rows: list[tuple] = []
        for profile, html in zip(b.column("profile").to_pylist(), b.column("html").to_pylist()):
            try:
                rows.append((*page_hits(html, *wanted.get(profile, ([],))), None))
            except Exception as e:  # one page's markup must not end the job
                rows.append(([], [], _failure(e)))
        hits, pieces, failures = zip(*rows) if rows else ((), (), ())
        kept = [c for c in b.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in kept), pa.array(hits, _HITS_ARROW), pa.array(pieces, pa.list_(pa.string())),
             pa.array(failures, pa.string())], [*kept, "hits", "pieces", "failure"])


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _page_slices(batches):
        rows: list[tuple] = []
        for html in b.column("html").to_pylist():
            try:
                rows.append((anchors(html), None))
            except Exception as e:  # as above
                rows.append(([], _failure(e)))
        hrefs, errors = zip(*rows) if rows else ((), ())
        kept = [c for c in b.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(hrefs, pa.list_(pa.string())),
                                          pa.array(errors, pa.string())], [*kept, "hrefs", "error"])


def scanned_anchors(pages: DataFrame) -> DataFrame:
    """One row per page: its columns but ``html``, its hrefs and the parser's error or null."""
    schema = T.StructType([f for f in pages.schema.fields if f.name != "html"]
                          + [T.StructField("hrefs", T.ArrayType(T.StringType())),
                             T.StructField("error", T.StringType())])
    return pages.mapInArrow(_anchor_batches, schema)


def page_anchors(pages: DataFrame) -> DataFrame:
    """X12 / UD2: one row per anchor (page columns, pos, href), document order kept.

    Every input column except ``html`` passes through the HTML step, so no
    join back to the page table is needed.
    """
    keep = [c for c in pages.columns if c != "html"]
    return scanned_anchors(pages).select(*keep, F.posexplode("hrefs").alias("pos", "href"))


def failed_pages(pages: DataFrame) -> DataFrame:
    """The pages that the parser can't read, with its error."""
    return scanned_anchors(pages).drop("hrefs").where(F.col("error").isNotNull())


# ------------------------------------------------------------------ rules over matches
class Rules:
    """Columns that evaluate rules over ``hits`` for one profile's list of selectors."""

    def __init__(self, selectors: list[str]):
        self.place = {s: k for k, s in enumerate(selectors)}

    def all_of(self, selector: str, inside: Column | None = None) -> Column:
        def wanted(h: Column) -> Column:
            own = h["pick"] == self.place[selector]
            return own if inside is None else own & (h["number"] > inside["number"]) & (h["number"] <= inside["last"])
        return F.filter("hits", wanted)

    def firsts(self, selectors: list[str], inside: Column | None = None) -> Column:
        """The first match of each selector that has one."""
        return F.array_compact(F.array(*(F.get(self.all_of(s, inside), F.lit(0)) for s in selectors)))

    def every(self, selectors: list[str], inside: Column | None = None) -> Column:
        return F.concat(*(self.all_of(s, inside) for s in selectors))

    @staticmethod
    def _source(h: Column, names: tuple[str, ...]) -> Column:
        return F.coalesce(*(text.nullif_empty(h["attrs"][n]) for n in names))

    @staticmethod
    def _some(items: Column) -> Column:
        return F.when(F.size(items) > 0, items)

    @staticmethod
    def text(h: Column, separator: str = " ") -> Column:
        return F.array_join(F.slice(F.col("pieces"), h["begin"] + 1, h["end"] - h["begin"]), separator)

    def _first_text(self, selectors: list[str], part) -> Column:
        return F.get(F.filter(F.transform(self.firsts(selectors), part), lambda t: t != ""), F.lit(0))

    def text_first(self, selectors):  # X1
        return self._first_text(selectors, lambda h: self.text(h)), None

    def own_text_first(self, selectors):  # X3
        return self._first_text(selectors, lambda h: h["own"]), None

    def _attribute(self, selectors: list[str], name: str) -> tuple[Column, Column]:
        """First non-empty attribute of the selectors' first matches; a match without it is an error."""
        decides = F.get(F.filter(self.firsts(selectors), lambda h: h["attrs"][name].isNull() | (h["attrs"][name] != "")),
                        F.lit(0))
        value = decides["attrs"][name]
        return value, F.when(decides.isNotNull() & value.isNull(), F.lit(f"'{name}'"))

    def attr_datetime(self, selectors):  # X4
        return self._attribute(selectors, "datetime")

    def video_body(self, selectors):  # X8
        value, error = self._attribute(selectors, "src")
        return text.https_prefix(value), error

    def images(self, selectors):  # X5
        def source(h: Column) -> Column:
            return F.coalesce(self._source(h, IMAGE_SOURCES),
                              text.nullif_empty(text.css_background_url(h["attrs"]["style"])))
        found = F.transform(self.every(selectors), lambda h: text.py_strip(source(h)))
        return self._some(F.array_sort(F.array_distinct(F.array_compact(found)))), None

    def videos(self, selectors):  # X7
        found = F.transform(self.every(selectors), lambda h: text.https_prefix(self._source(h, VIDEO_SOURCES)))
        return self._some(F.array_compact(found)), None

    def images_captioned(self, figures, images, captions):  # X6
        def figure(f: Column) -> Column:
            image = F.get(self.firsts(images, f), F.lit(0))
            caption = F.get(self.firsts(captions, f), F.lit(0))
            return F.struct(self._source(image, IMAGE_SOURCES).alias("url"), F.when(caption.isNotNull(), self.text(caption, "")).alias("descripcion"))
        return self._some(F.filter(F.transform(self.every(figures), figure), lambda i: i["url"].isNotNull())), None

    def text_all(self, selectors):  # X2
        return F.transform(self.every(selectors), lambda h: self.text(h))

    def body(self, selectors):  # X9
        return text.join_lines(self._some(self.text_all(selectors))), None

    def body_excluding(self, selectors, excluded):  # X11
        blocks = self.every(excluded)
        free = F.filter(self.every(selectors), lambda h: (h["end"] > h["begin"]) & ~F.exists(
            blocks, lambda b: (h["number"] > b["number"]) & (h["number"] <= b["last"])))
        return text.join_lines(self._some(F.transform(free, lambda h: self.text(h)))), None

    def live_entries(self, entries, stamps, bodies):  # X10
        def entry(e: Column) -> Column:
            stamp = F.get(F.filter(self.firsts(stamps, e), lambda h: h["attrs"]["datetime"].isNotNull()), F.lit(0))
            parts = F.transform(F.filter(self.every(bodies, e), lambda h: h["end"] > h["begin"]), lambda h: self.text(h))
            return F.struct(stamp["attrs"]["datetime"].alias("fecha"),
                            text.join_lines(self._some(parts)).alias("cuerpo"))
        return self._some(F.transform(self.every(entries), entry)), None

    def chain(self, rules: list[tuple], kind: T.DataType) -> tuple[Column, Column | None]:
        """The first rule with a result; if none has one, the last rule's."""
        *firsts, last = [getattr(self, k)(*args) for k, *args in rules]
        error = [e for _, e in (*firsts, last) if e is not None]
        value = last[0]
        for v, _ in reversed(firsts):
            value = F.when(text.non_empty(v) if isinstance(kind, T.StringType) else v.isNotNull(), v).otherwise(value)
        return value, reduce(lambda a, b: F.coalesce(a, b), error) if error else None


def _profile_columns(profile: dict) -> tuple[dict[str, Column], Column]:
    """Every field's value and the first error of a profile."""
    rules = Rules(selectors_of(profile))
    types = {f.name: f.dataType for f in schemas.EXTRACTED.fields}
    category = (rules.chain(profile["categoria"], types["categoria"])[0]
                if "categoria" in profile else F.lit(None).cast("string"))
    values, errors = {}, [F.col("failure")]
    for field in FIELDS:
        rule, kind = profile.get(field), types[field]
        value, error = F.lit(None).cast(kind), None
        if isinstance(rule, dict):
            errors.append(F.when(category.isNull(), F.lit(NO_CATEGORY)))
            now = text.lower_trim(category)
            cases = [(now == n, *rules.chain([r], kind)) for n, r in rule.items() if n != "*"]
            value, error = rules.chain([rule["*"]], kind) if "*" in rule else (value, None)
            error = F.lit(None).cast("string") if error is None else error
            for holds, v, e in cases:
                value = F.when(holds, v).otherwise(value)
                error = F.when(holds, F.lit(None).cast("string") if e is None else e).otherwise(error)
        elif rule:
            value, error = rules.chain(rule, kind)
        values[field] = value.cast(kind)
        if error is not None:
            errors.append(error)
    if profile.get("_categoria_required"):
        errors.append(F.when(category.isNull(), F.lit(NO_CATEGORY)))
    return values, F.coalesce(*errors)


def raw_articles(pages: DataFrame) -> DataFrame:
    """Run the profile rules on (page_id, url, medio, profile, html) rows; an error leaves the fields null."""
    base = pages.select("page_id", "url", "medio", "profile", "html")
    schema = T.StructType([f for f in base.schema.fields if f.name != "html"]).add(
        "hits", HITS).add("pieces", T.ArrayType(T.StringType())).add("failure", T.StringType())
    scanned = base.mapInArrow(_hit_batches, schema)
    made = {name: _profile_columns(p) for name, p in config.PROFILES.items()}

    def by_profile(pick) -> Column:
        return F.coalesce(*(F.when(F.col("profile") == n, pick(c)) for n, c in made.items()))

    error = F.coalesce(F.col("failure"), by_profile(lambda c: c[1]))
    staged = scanned.withColumn("error", error)
    return staged.select("page_id", "url", "medio", "profile",
                         *(F.when(F.col("error").isNull(), by_profile(lambda c, f=f: c[0][f])).alias(f) for f in FIELDS),
                         "error")


def profiles_df(spark) -> DataFrame:
    """Validation settings per profile (three rows; broadcast is bounded by config)."""
    rows = [(k, p.get("_required", []), p.get("_fecha_optional_for"),
             bool(p.get("_cuerpo_or_imagenes")), bool(p.get("_date_to_spanish")),
             (p.get("_constants") or {}).get("tipo_multimedia"))
            for k, p in config.PROFILES.items()]
    return spark.createDataFrame(
        rows, "profile string, required array<string>, fecha_optional_for string, "
              "cuerpo_or_imagenes boolean, date_to_spanish boolean, tipo_multimedia string")


def _falsy(c):
    return c.isNull() | (c == F.lit(""))


def validate(raw: DataFrame, profiles: DataFrame) -> DataFrame:
    """F7-F9, X15, P8, DT2, U4 on extraction output (Spark SQL only)."""
    j = raw.join(F.broadcast(profiles), "profile", "left")
    j = dates.add_iso_to_spanish(j, "fecha", "__fecha_es")
    j = j.withColumn("fecha", F.when(F.col("date_to_spanish"), F.col("__fecha_es"))
                     .otherwise(F.col("fecha"))).drop("__fecha_es")
    req = F.coalesce(F.col("required"), F.array().cast("array<string>"))
    cat_lt = text.lower_trim("categoria")
    need_fecha = (F.array_contains(req, "fecha") & _falsy(F.col("fecha"))
                  & ~F.coalesce(cat_lt == F.col("fecha_optional_for"), F.lit(False)))
    has_imgs = F.coalesce(F.size("imagenes") > 0, F.lit(False))
    need_titulo = F.array_contains(req, "titulo") & _falsy(F.col("titulo"))
    need_cuerpo = (F.array_contains(req, "cuerpo") & _falsy(F.col("cuerpo"))
                   & ~(F.coalesce(F.col("cuerpo_or_imagenes"), F.lit(False)) & has_imgs))
    missing = F.array_compact(F.array(F.when(need_fecha, F.lit("fecha")),
                                      F.when(need_titulo, F.lit("titulo")),
                                      F.when(need_cuerpo, F.lit("cuerpo"))))
    j = j.withColumn("missing", F.when(F.col("error").isNull(), missing)
                     .otherwise(F.array().cast("array<string>")))
    status = F.when(F.col("error").isNotNull() | (F.size("missing") > 0), F.lit("error")) \
        .otherwise(F.lit("success"))
    msg = (F.when(F.col("error").isNotNull(),
                  F.concat(F.lit("Error en el scraping: "), F.col("error")))
           .when(F.size("missing") > 0,
                 F.concat(F.lit("Error en el scraping: Faltaron los siguientes parámetros "
                                "críticos: ['"),
                          F.array_join("missing", "', '"), F.lit("']"))))
    return j.select(
        "page_id", "url", "medio", "profile", "categoria", "titulo", "fecha", "autor",
        "desc_autor", "abstract", "cuerpo", "cuerpo_en_vivo",
        F.array_sort(F.array_distinct("multimedia")).alias("multimedia"),
        F.col("tipo_multimedia"), "imagenes", "videos", "missing",
        status.alias("status"), msg.alias("error"))


def extract_articles(pages: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """X13-X15 / UD1 / J6: validated article rows, one per page."""
    profiles = profiles if profiles is not None else profiles_df(pages.sparkSession)
    return validate(raw_articles(pages), profiles)


UNKNOWN_OUTLET = "Medio no encontrado en configuraciones"


def extract_outlet_pages(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """(page_id, url, html) rows through the profile of the outlet that the host names.

    ``sites`` (D1) names a host by its start page. Pages of other hosts keep their host as outlet
    and become errors without being parsed.
    """
    j = (config.with_outlet(pages.select("page_id", "url", "html"), sites, "profile")
         .withColumn("medio", F.coalesce("outlet", "host")))
    asked = j.withColumn("html", F.when(F.col("profile").isNotNull(), F.col("html")))
    done = extract_articles(asked.select("page_id", "url", "medio", "profile", "html"))
    unknown = F.col("profile").isNull()
    return done.withColumns({"status": F.when(unknown, F.lit("error")).otherwise(F.col("status")),
                             "error": F.when(unknown, F.lit(UNKNOWN_OUTLET)).otherwise(F.col("error"))})


def article_a(articles: DataFrame, outlet: bool = False) -> DataFrame:
    """D6 record (profile A) of successful articles; ``outlet`` adds the writer's partition column."""
    own = articles.filter((F.col("status") == "success") & (F.col("profile") == "A"))
    return own.select(
        *(["medio"] if outlet else []), "titulo", "fecha", "autor", "desc_autor", "abstract", "cuerpo", "multimedia",
        "tipo_multimedia", "url")


def article_b(articles: DataFrame, outlet: bool = False) -> DataFrame:
    """D7 record (profile B) of successful articles; ``outlet`` as above."""
    own = articles.filter((F.col("status") == "success") & (F.col("profile") == "B"))
    return own.select(
        *(["medio"] if outlet else []), "categoria", "titulo", "fecha", "autor", "abstract", "cuerpo", "cuerpo_en_vivo",
        "imagenes", "videos", "url")
