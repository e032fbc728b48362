"""Date and time column expressions (DT1-DT7).

All parsing mirrors Python's ``strptime`` / ``fromisoformat`` acceptance with
anchored regular expressions, then builds the value with ``try_make_*`` so that
invalid calendar dates (Feb 30) come out null instead of failing the task. Log
times carry no zone; they are ``timestamp_ntz`` values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text
from .text import before_pipe, cached_expr, col, is_blank, non_empty

# ---- fixed values: Spanish day names (Monday first) and month names --------
DIAS_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MESES_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio",
            "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
# ---- end of fixed values ----------------------------------------------------

# Field patterns accepted by Python's strptime directives.
_Y = r"([0-9]{4})"
_m = r"(1[0-2]|0[1-9]|[1-9])"
_d = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_H = r"(2[0-3]|[01][0-9]|[0-9])"
_M = r"([0-5][0-9]|[0-9])"
_S = r"([0-5][0-9]|[0-9])"

LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_LOG_TIME_RE = rf"(?U)^{_Y}-{_m}-{_d}\s+{_H}:{_M}:{_S}$"

# date formats tried in order by the publication-date normaliser
_YMD_DASH = rf"^{_Y}-{_m}-{_d}$"
_DMY_DASH = rf"^{_d}-{_m}-{_Y}$"
_DMY_SLASH = rf"^{_d}/{_m}/{_Y}$"
_YMD_SLASH = rf"^{_Y}/{_m}/{_d}$"

# ISO 8601 date-time as accepted by datetime.fromisoformat: the written date (calendar or
# week date, extended or basic), any one separator, a time of 1-3 fields (optional
# fraction) and an optional offset. Only the written date is used; the offset is never applied.
_ISO_TIME = (r"(?:.([01][0-9]|2[0-3])(?::?([0-5][0-9])(?::?([0-5][0-9])(?:[.,][0-9]+)?)?)?"
             r"(?:Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9](?::?[0-5][0-9](?:\.[0-9]+)?)?)?)?)?$")
_ISO_RE = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})" + _ISO_TIME
_ISO_BASIC_RE = r"^[0-9]{8}" + _ISO_TIME
_ISO_WEEK_RE = r"^([0-9]{4})(?:-W([0-9]{2})(?:-([1-7])(?![0-9]))?|W([0-9]{2})([1-7])?)" + _ISO_TIME


def _date_from(c: Column, pattern: str, spark_fmt: str) -> Column:
    """Date of a string whose shape ``pattern`` already validates; null if invalid.

    The regex gate gives Python's acceptance; Spark's strict resolver then
    rejects impossible calendar dates. Spaces (Python's ' 5' day form) are
    dropped before parsing, the shape having been checked.
    """
    return F.when(c.rlike(pattern),
                  F.try_to_date(F.regexp_replace(c, " ", ""), spark_fmt))


@cached_expr
def parse_log_time(c) -> Column:
    """DT1: parse ``%Y-%m-%d %H:%M:%S`` (unpadded fields allowed); null when it fails."""
    c = col(c)
    flat = F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "- ", "-")
    # a zone-less type from the start: the session's zone and its clock changes play no part
    return F.when(c.rlike(_LOG_TIME_RE), flat.try_cast("timestamp_ntz"))


@cached_expr
def spanish_date(d) -> Column:
    """DT4: date -> 'Día DD mes de YYYY'."""
    d = col(d)
    dias = F.array(*[F.lit(x) for x in DIAS_ES])
    meses = F.array(*[F.lit(x) for x in MESES_ES])
    return F.concat(
        F.element_at(dias, F.weekday(d) + 1), F.lit(" "),
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit(" "),
        F.element_at(meses, F.month(d)), F.lit(" de "), F.year(d).cast("string"))


@cached_expr
def iso_written_date(c) -> Column:
    """Written (local) date of an ISO date-time string, null if not ISO."""
    c = col(c)
    return (F.when(c.rlike(_ISO_RE), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
            .when(c.rlike(_ISO_BASIC_RE), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd"))
            .when(c.rlike(_ISO_WEEK_RE), iso_week_date(c)))


@cached_expr
def iso_week_date(c) -> Column:
    """DT2: date of an ISO week date (``2020-W53-5``, ``2020W535``; without a day: its Monday).

    Week 1 holds January 4th. A week that its year does not have gives null.
    """
    c = col(c)
    part = lambda i: text.nullif_empty(F.regexp_extract(c, _ISO_WEEK_RE, i))
    week = F.coalesce(part(2), part(4)).try_cast("int")
    day = F.coalesce(part(3), part(5), F.lit("1")).try_cast("int")
    fourth = F.try_to_date(F.concat(F.regexp_extract(c, _ISO_WEEK_RE, 1), F.lit("-01-04")), "yyyy-MM-dd")
    date = F.date_add(fourth, -F.weekday(fourth) + (week - 1) * 7 + day - 1)
    return F.when((week >= 1) & (F.weekofyear(date) == week), date)


@cached_expr
def normalize_pub_date(c) -> Column:
    """DT3: publication date -> histogram key; null for blank input.

    Text before '|' is used. ISO strings (with 'T' and a zone marker) give their
    written date; else ``%Y-%m-%d``, ``%d-%m-%Y``, ``%d/%m/%Y``, ``%Y/%m/%d`` are
    tried in order; unparsed text passes through.
    """
    raw = col(c)
    return normalize_pub_date_part(before_pipe(raw), is_blank(raw))


@cached_expr
def normalize_pub_date_part(p, blank) -> Column:
    """DT3 on the already split and stripped text ``p`` (``blank``: raw was blank).

    Lets callers compute the split once in an earlier projection, which keeps
    the generated code small.
    """
    p, blank = col(p), col(blank)
    looks_iso = (p.contains("T") & (p.contains("Z") | p.contains("+")
                                    | F.right(p, F.lit(6)).contains("-")))
    cut = F.when(p.contains("."), F.substring_index(p, ".", 1)).otherwise(
        F.regexp_replace(p, "Z+$", ""))
    cleaned = F.regexp_replace(cut, "Z+$", "")
    iso = F.when(looks_iso, iso_written_date(cleaned))
    d = F.coalesce(iso,
                   _date_from(p, _YMD_DASH, "y-M-d"),
                   _date_from(p, _DMY_DASH, "d-M-y"),
                   _date_from(p, _DMY_SLASH, "d/M/y"),
                   _date_from(p, _YMD_SLASH, "y/M/d"))
    out = F.when(d.isNotNull(), spanish_date(d)).otherwise(p)
    return F.when(~blank, out)


@cached_expr
def iso_to_spanish(c) -> Column:
    """DT2: article date (ISO, or ``%Y-%m-%d``) -> Spanish text; failure keeps the input."""
    c = col(c)
    cleaned = F.when(c.endswith("Z"), F.replace(c, F.lit("Z"), F.lit("+00:00"))).otherwise(c)
    d = F.when(cleaned.contains("T"), iso_written_date(cleaned)).otherwise(
        _date_from(c, _YMD_DASH, "y-M-d"))
    return F.when(non_empty(c) & d.isNotNull(), spanish_date(d)).otherwise(c)


@cached_expr
def format_log_time(ts) -> Column:
    """DT6: timestamp -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col(ts), LOG_TIME_FORMAT)


@cached_expr
def elapsed_ms(start, end) -> Column:
    """DT5: milliseconds between two timestamps (double)."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / 1000.0


@cached_expr
def elapsed_seconds(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / 1e6


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


@cached_expr
def batch_id(ts) -> Column:
    """DT7: batch id = whole epoch seconds of a (zone-less) timestamp."""
    return F.timestamp_diff("SECOND", epoch_ntz(), col(ts))


def truncate_to_second(ts) -> Column:
    return F.date_trunc("second", col(ts)).cast("timestamp_ntz")


@cached_expr
def pub_date_value(p) -> Column:
    """DT3 steps 2-3 on the split text ``p``: the parsed date, or null."""
    p = col(p)
    looks_iso = (p.contains("T") & (p.contains("Z") | p.contains("+")
                                    | F.right(p, F.lit(6)).contains("-")))
    cut = F.when(p.contains("."), F.substring_index(p, ".", 1)).otherwise(p)
    iso = F.when(looks_iso, iso_written_date(F.regexp_replace(cut, "Z+$", "")))
    return F.coalesce(iso,
                      _date_from(p, _YMD_DASH, "y-M-d"),
                      _date_from(p, _DMY_DASH, "d-M-y"),
                      _date_from(p, _DMY_SLASH, "d/M/y"),
                      _date_from(p, _YMD_SLASH, "y/M/d"))


def add_pub_date(df, src: str, out: str = "fecha"):
    """DT3 as staged projections (same result as ``normalize_pub_date``).

    split text -> parsed date -> Spanish text; each step refers to the previous
    step's column, so the split and the parse are evaluated once per row.
    """
    d = df.select("*", before_pipe(src).alias("__fp"), is_blank(src).alias("__fb"))
    d = d.select("*", pub_date_value("__fp").alias("__fd"))
    text = F.when(F.col("__fd").isNotNull(), spanish_date("__fd")).otherwise(F.col("__fp"))
    return d.select("*", F.when(~F.col("__fb"), text).alias(out)).drop("__fp", "__fd")


def add_iso_to_spanish(df, src: str, out: str):
    """DT2 as staged projections (same result as ``iso_to_spanish``)."""
    c = F.col(src)
    cleaned = F.when(c.endswith("Z"), F.replace(c, F.lit("Z"), F.lit("+00:00"))).otherwise(c)
    d = df.select("*", F.when(non_empty(c) & cleaned.contains("T"), iso_written_date(cleaned))
                  .when(non_empty(c), _date_from(c, _YMD_DASH, "y-M-d")).alias("__d2"))
    res = F.when(F.col("__d2").isNotNull(), spanish_date("__d2")).otherwise(c)
    return d.select("*", res.alias(out)).drop("__d2")
