"""Numeric column expressions (MA1-MA3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import cached_expr, col, non_empty


def safe_div(num, den) -> Column:
    """MA1: num / den when den > 0, else 0.0 (double)."""
    num, den = col(num), col(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def round_to(c, places: int) -> Column:
    """MA2: rounding is presentation only; used by the export step."""
    return F.round(col(c), places)


# Python's float() accepts surrounding white space, '_' between digits, 'inf'
# and 'nan'; Spark's cast accepts the plain decimal / exponent forms used in
# logs. Both reject '' and words.
@cached_expr
def to_double(c) -> Column:
    """MA3: string -> double; '' and unparseable text give null (skipped)."""
    c = col(c)
    return F.when(non_empty(c), F.trim(c).try_cast("double"))
