"""JSON column expressions (JS1, JS2, MP1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col, is_blank

CORRUPT = "_corrupt_record"


def decode(text, schema: T.StructType) -> Column:
    """JS1/JS2: parse a message; the struct gains ``_corrupt_record`` for bad text.

    Blank text gives null; broken text gives a struct whose only non-null field
    is ``_corrupt_record`` (kept for quarantine, never lost).
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    t = col(text)
    parsed = F.from_json(t, with_corrupt, {"mode": "PERMISSIVE",
                                           "columnNameOfCorruptRecord": CORRUPT})
    return F.when(~is_blank(t), parsed)


def decode_reason(text, decoded) -> Column:
    """JS2: why a message did not decode: 'blank', 'not JSON', 'not an object', 'wrong type'; null if it did.

    ``decoded`` is the column that ``decode`` made of ``text``.
    """
    t, d = col(text), col(decoded)
    tree = F.try_parse_json(t)
    why = (F.when(tree.isNull(), F.lit("not JSON"))
           .when(~F.schema_of_variant(tree).startswith("OBJECT"), F.lit("not an object"))
           .otherwise(F.lit("wrong type")))
    return F.when(is_blank(t), F.lit("blank")).when(d[CORRUPT].isNotNull(), why)


def encode(*cols) -> Column:
    """JS1: struct -> JSON text (null fields dropped, UTF-8 kept)."""
    return F.to_json(F.struct(*cols))


def tags_array(tags) -> Column:
    """Schema drift of ``tags``: a JSON array in text form, or one plain string."""
    t = col(tags)
    arr = F.from_json(t, T.ArrayType(T.StringType()))
    return F.when(F.ltrim(t).startswith("["), arr).otherwise(F.array(t))


def get_or(m, key, default) -> Column:
    """MP1: map lookup with default."""
    return F.coalesce(F.try_element_at(col(m), F.lit(key)), F.lit(default))
