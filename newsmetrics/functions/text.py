"""String column expressions (STR5-STR9 and helpers shared by other modules)."""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def cached_expr(fn):
    """Memoise a column-expression builder whose arguments are plain values.

    Column objects are immutable and reusable across plans; building a large
    expression costs one py4j round trip per node, so builders called with
    the same column names return the already built Column (per SparkContext).
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrap(*args):
        if all(isinstance(a, (str, int, float, bool, tuple, type(None))) for a in args):
            active = SparkContext._active_spark_context
            app = active.applicationId if active else None
            if cache.get("app") != app:  # Columns of a stopped application are dead
                cache.clear()
                cache["app"] = app
            key = (app, args)
            c = cache.get(key)
            if c is None:
                c = cache[key] = fn(*args)
            return c
        return fn(*args)
    return wrap

# Python's str.strip() removes Unicode white space plus the four C0 separators
# U+001C..U+001F; Spark's trim() only removes ' '.
_WS = r"[\s\x{1C}-\x{1F}]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cached_expr
def py_strip(c) -> Column:
    """``str.strip()`` with Python's notion of white space."""
    return F.regexp_replace(col(c), _STRIP_RE, "")


@cached_expr
def is_blank(c) -> Column:
    """True for null, '' and white-space-only strings (``not s or not s.strip()``)."""
    c = col(c)
    return c.isNull() | (F.length(py_strip(c)) == 0)


@cached_expr
def non_empty(c) -> Column:
    """Python truthiness of a string: not null and not ''."""
    c = col(c)
    return c.isNotNull() & (c != F.lit(""))


@cached_expr
def before_pipe(c) -> Column:
    """STR8: text before the first '|', stripped (whole text stripped when no pipe)."""
    c = col(c)
    return py_strip(F.substring_index(c, "|", 1))


@cached_expr
def lower_trim(c) -> Column:
    """STR7: ``s.lower().strip()`` used to compare categories."""
    return py_strip(F.lower(col(c)))


@cached_expr
def https_prefix(c) -> Column:
    """STR5: protocol-relative ``//host/x`` becomes ``https://host/x``."""
    c = col(c)
    return F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).otherwise(c)


@cached_expr
def css_background_url(style) -> Column:
    """STR6: URL of ``background-image: url(...)`` in a style attribute, quotes stripped.

    Null when the pattern is absent.
    """
    style = col(style)
    pat = r"background-image\s*:\s*url\((.*?)\)"
    raw = F.regexp_extract(style, pat, 1)
    stripped = F.regexp_replace(raw, "^[ \"']+|[ \"']+$", "")
    return F.when(style.rlike(pat), stripped)


@cached_expr
def join_lines(arr) -> Column:
    """STR9: join an array of strings with newlines."""
    return F.array_join(col(arr), "\n")


@cached_expr
def nullif_empty(c) -> Column:
    c = col(c)
    return F.when(c != F.lit(""), c)


def first_non_empty(*cols) -> Column:
    """First candidate that is neither null nor ''."""
    return F.coalesce(*[nullif_empty(c) for c in cols])
