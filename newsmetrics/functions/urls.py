"""URL column expressions: STR1-STR4 and the link predicates F1/F2/F15."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import cached_expr, col

# ---- fixed values: outlet host markers and category markers -----------------
BIOBIO_HOST = "biobiochile.cl"
LATERCERA_HOST = "latercera.com"
BIOBIO_MARKERS = ["/especial/", "/noticias/"]   # tried in this order, first occurrence
BIOBIO_SELF = "biobiochile"
NOTICIAS = "noticias"
SPONSORED = "noticias-patrocinadas"
NO_CATEGORY = "sin-categoria"
MAX_CATEGORY_LEVELS = 3
# ---- end of fixed values ----------------------------------------------------

_AUTHORITY_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)"
_PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


@cached_expr
def url_path(u) -> Column:
    """STR4: path component (``urlsplit(u).path``)."""
    return F.regexp_extract(col(u), _PATH_RE, 1)


_REFERENCE_RE = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


@cached_expr
def remove_dots(path) -> Column:
    """STR3: a path without ``.`` and ``..`` segments, folded over a stack of segments.

    ``..`` takes back the segment before it, if there is one; a path that ends in a dot
    segment ends in a slash; an absolute path stays absolute.
    """
    path = col(path)
    segments = F.split(path, "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(segments, empty, lambda stack, s: F.when(s == ".", stack)
                       .when(s == "..", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0))))
                       .otherwise(F.concat(stack, F.array(s))))
    closed = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(closed, "/")
    folded = F.when(path.startswith("/") & ~joined.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), folded).otherwise(path)


def _part(reference: Column, group: int) -> Column:
    return F.regexp_extract(reference, _REFERENCE_RE, group)


@cached_expr
def resolve_href(base, href) -> Column:
    """STR3: resolve an href against the page URL, only when it starts with '/', as ``urljoin`` does.

    ``//host/x`` takes the page's scheme and keeps its path as it is; ``/x`` takes scheme
    and authority and loses its dot segments; an empty query or fragment goes.
    Anything else (absolute, relative without slash) is returned untouched.
    """
    base, raw = col(base), col(href)
    href = F.translate(raw, "\t\r\n", "")
    scheme = F.regexp_extract(base, _AUTHORITY_RE, 1)
    authority = F.regexp_extract(base, _AUTHORITY_RE, 2)
    has_auth = base.rlike(_AUTHORITY_RE)
    query, fragment = (F.when(F.length(_part(href, g)) > 1, _part(href, g)).otherwise("") for g in (4, 5))
    host = href.rlike("^//[^/?#]")
    path = F.when(href.startswith("//"), _part(href, 3)).otherwise(F.regexp_extract(href, "^([^?#]*)", 1))
    joined = F.when(host, F.concat(scheme, F.lit("://"), _part(href, 2), path, query, fragment)).otherwise(
        F.concat(scheme, F.lit(":"), authority, remove_dots(path), query, fragment))
    return F.when(href.startswith("/") & has_auth, joined).otherwise(raw)


@cached_expr
def resolve_reference(base, reference) -> Column:
    """Any reference against an absolute base URL, by RFC 3986, 5.2 (strict)."""
    base, ref = col(base), col(reference)
    has_scheme, has_authority = ref.rlike("^[^:/?#]+:"), ref.rlike("^(?:[^:/?#]+:)?//")
    has_query = ref.rlike(r"^[^#]*\?")
    path, base_path = _part(ref, 3), _part(base, 3)
    base_authority = base.rlike("^(?:[^:/?#]+:)?//")
    merged = F.when(base_authority & (base_path == ""), F.concat(F.lit("/"), path)).otherwise(
        F.concat(F.regexp_extract(base_path, "^(.*/)?", 0), path))
    own = has_scheme | has_authority
    new_path = (F.when(own | path.startswith("/"), remove_dots(path)).when(path == "", base_path)
                .otherwise(remove_dots(merged)))
    query = F.when(own | (path != "") | has_query, _part(ref, 4)).otherwise(_part(base, 4))
    scheme = F.when(has_scheme, _part(ref, 1)).otherwise(_part(base, 1))
    authority = (F.when(has_authority, F.concat(F.lit("//"), _part(ref, 2))).when(has_scheme, F.lit(""))
                 .when(base_authority, F.concat(F.lit("//"), _part(base, 2))).otherwise(F.lit("")))
    return F.concat(scheme, F.lit(":"), authority, new_path, query, _part(ref, 5))


@cached_expr
def category_slug(cat_url) -> Column:
    """STR2: last path segment of a biobiochile category URL, '' for other outlets."""
    u = col(cat_url)
    last = F.try_element_at(F.split(F.regexp_replace(u, "/+$", ""), "/"), F.lit(-1))
    return F.when(u.contains(BIOBIO_HOST), last).otherwise(F.lit(""))


def _after_first(u: Column, marker: str) -> Column:
    """Text after the first occurrence of ``marker`` (caller checks presence)."""
    return F.substr(u, F.instr(u, marker) + len(marker))


@cached_expr
def category(link, slug) -> Column:
    """STR1: category tags of a news link (get_category rules)."""
    u, slug = col(link), col(slug)

    # biobiochile: path after the first '/especial/', else after the first '/noticias/'
    path = F.when(u.contains(BIOBIO_MARKERS[0]), _after_first(u, BIOBIO_MARKERS[0])) \
            .when(u.contains(BIOBIO_MARKERS[1]), _after_first(u, BIOBIO_MARKERS[1]))
    parts = F.filter(F.split(path, "/"), lambda p: p != F.lit(""))
    year_pos = F.array_position(F.transform(parts, lambda p: p.rlike("^[0-9]{4}$")), True)
    take = F.when(year_pos > 0, F.least(year_pos - 1, F.lit(MAX_CATEGORY_LEVELS))) \
            .otherwise(F.least(F.size(parts), F.lit(MAX_CATEGORY_LEVELS)))
    cats = F.slice(parts, 1, take)
    cats = F.when(F.lower(F.try_element_at(cats, F.lit(1))) == BIOBIO_SELF,
                  F.slice(cats, 2, F.greatest(F.size(cats) - 1, F.lit(0)))).otherwise(cats)
    cats = F.when((F.size(cats) >= 2) & (F.lower(F.try_element_at(cats, F.lit(2))) == NOTICIAS),
                  F.concat(F.slice(cats, 1, 1),
                           F.slice(cats, 3, F.greatest(F.size(cats) - 2, F.lit(0))))).otherwise(cats)
    biobio = (F.when(path.isNull() | (path == ""), slug)
              .when(F.size(cats) == 0, slug)
              .when(F.lower(F.try_element_at(cats, F.lit(1))) == SPONSORED, F.lit(SPONSORED))
              .otherwise(F.array_join(cats, "/")))

    # latercera: first non-empty path segment
    segs = F.filter(F.split(url_path(u), "/"), lambda p: p != F.lit(""))
    latercera = F.when(F.size(segs) > 0, F.try_element_at(segs, F.lit(1))).otherwise(F.lit(NO_CATEGORY))

    return (F.when(u.contains(BIOBIO_HOST), biobio)
            .when(u.contains(LATERCERA_HOST), latercera)
            .otherwise(slug))


@cached_expr
def contains_pattern(u, pattern) -> Column:
    """category link test (substring)."""
    return F.instr(col(u), col(pattern) if not isinstance(pattern, str) else F.lit(pattern)) > 0


def matches_any(u, patterns) -> Column:
    """The link contains any of the patterns (array<string> column)."""
    u = col(u)
    return F.exists(col(patterns), lambda p: F.instr(u, p) > 0)


def add_category(df, link: str, slug: str, out: str = "categoria"):
    """STR1 as staged projections (same rules as ``category``).

    Each step refers to the previous step's columns, so the path split is
    evaluated once per row instead of being re-embedded in every branch.
    """
    u = F.col(link)
    d = df.select("*",
                  F.when(u.contains(BIOBIO_MARKERS[0]), _after_first(u, BIOBIO_MARKERS[0]))
                   .when(u.contains(BIOBIO_MARKERS[1]), _after_first(u, BIOBIO_MARKERS[1]))
                   .alias("__cp"),
                  url_path(u).alias("__lp"))
    d = d.select("*", F.filter(F.split("__cp", "/"), lambda p: p != F.lit("")).alias("__pa"),
                 F.try_element_at(F.filter(F.split("__lp", "/"), lambda p: p != F.lit("")),
                                  F.lit(1)).alias("__l1"))
    ypos = F.array_position(F.transform("__pa", lambda p: p.rlike("^[0-9]{4}$")), True)
    d = d.select("*", F.least(F.when(ypos > 0, ypos - 1).otherwise(F.size("__pa")),
                              F.lit(MAX_CATEGORY_LEVELS)).alias("__L"))
    first = F.lower(F.try_element_at("__pa", F.lit(1)))
    d = d.select("*", F.when((F.col("__L") >= 1) & (first == BIOBIO_SELF), 2)
                 .otherwise(1).alias("__s"))
    d = d.select("*", (F.col("__L") - F.col("__s") + 1).alias("__m"))
    second = F.lower(F.try_element_at("__pa", F.col("__s") + 1))
    d = d.select("*", ((F.col("__m") >= 2) & (second == NOTICIAS)).alias("__rm"))
    kept = F.when(F.col("__rm"),
                  F.concat(F.slice("__pa", F.col("__s"), F.lit(1)),
                           F.slice("__pa", F.col("__s") + 2, F.greatest(F.col("__m") - 2, F.lit(0)))))\
        .otherwise(F.slice("__pa", F.col("__s"), F.greatest(F.col("__m"), F.lit(0))))
    n_kept = F.col("__m") - F.col("__rm").cast("int")
    head = F.lower(F.try_element_at("__pa", F.col("__s")))
    biobio = (F.when(F.col("__cp").isNull() | (F.col("__cp") == ""), F.col(slug))
              .when(n_kept <= 0, F.col(slug))
              .when(head == SPONSORED, F.lit(SPONSORED))
              .otherwise(F.array_join(kept, "/")))
    res = (F.when(u.contains(BIOBIO_HOST), biobio)
           .when(u.contains(LATERCERA_HOST), F.coalesce(F.col("__l1"), F.lit(NO_CATEGORY)))
           .otherwise(F.col(slug)))
    return d.select("*", res.alias(out)).drop("__cp", "__lp", "__pa", "__l1", "__L", "__s",
                                              "__m", "__rm")
