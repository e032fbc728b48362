"""Scrape-result log: record builder (P1), batch stamp (P4), typed view, batch scoping (ST3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_pub_date, elapsed_ms, format_log_time, parse_log_time
from ..functions.numeric import to_double
from ..functions.text import before_pipe, cached_expr, col, is_blank

RAW_COLUMNS = ["arrival_seq", "url", "medio", "starting_time", "status",
               "fecha_publicacion", "finishing_time", "duration_ms", "error",
               "id_logging_process"]


def _num_text(ms: Column) -> Column:
    """Render a millisecond double as Python's ``str(float)`` does for log values."""
    as_long = ms.cast("long")
    return F.when(ms == as_long.cast("double"),
                  F.concat(as_long.cast("string"), F.lit(".0"))).otherwise(
        # Spark writes doubles from 10^7 on in scientific form; decimals stay plain
        F.when(F.abs(ms) < 1e7, ms.cast("string"))
        .otherwise(F.regexp_replace(ms.cast("decimal(38,6)").cast("string"), "0+$", "")))


def build_log(results: DataFrame, seq: str = "arrival_seq") -> DataFrame:
    """Scrape outcome rows -> raw log records (all strings, '' for absent).

    Input columns: ``url, medio, start_ts, finish_ts (nullable), status, error,
    fecha_publicacion`` plus the ordering column ``seq``.
    """
    fin = col("finish_ts")
    return results.select(
        F.col(seq).alias("arrival_seq"),
        F.col("url"),
        F.coalesce(F.col("medio"), F.lit("")).alias("medio"),
        format_log_time("start_ts").alias("starting_time"),
        F.col("status"),
        F.coalesce(F.when(F.col("fecha_publicacion") != "", F.col("fecha_publicacion")),
                   F.lit("")).alias("fecha_publicacion"),
        F.when(fin.isNotNull(), format_log_time(fin)).otherwise(F.lit("")).alias("finishing_time"),
        F.when(fin.isNotNull(), _num_text(elapsed_ms("start_ts", fin))).otherwise(F.lit(""))
         .alias("duration_ms"),
        F.coalesce(F.col("error"), F.lit("")).alias("error"),
    )


def stamp_batch(logs: DataFrame, batch_id) -> DataFrame:
    """Every log carries the logger's working batch id."""
    v = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("long")
    return logs.withColumn("id_logging_process", v)


def typed(raw: DataFrame) -> DataFrame:
    """Typed view of D8: A1 key, DT1 times, MA3 duration, DT3 date; bad values -> null.

    The publication date is normalised by staged projections (``add_pub_date``)
    so each step is evaluated once per row.
    """
    staged = add_pub_date(raw, "fecha_publicacion", "__fecha")
    return staged.select(*_typed_columns())


@cached_expr
def _typed_columns() -> tuple:
    return (
        F.col("arrival_seq"),
        F.coalesce(F.col("medio"), F.lit("unknown")).alias("medio"),
        F.col("url"),
        F.col("status"),
        parse_log_time("starting_time").alias("start_ts"),
        parse_log_time("finishing_time").alias("finish_ts"),
        to_double("duration_ms").alias("dur_ms"),
        F.col("__fecha").alias("fecha"),
        # cheap pre-check (F11) so filters never inline the date normaliser
        (~F.col("__fb")).alias("has_fecha"),
        F.col("id_logging_process"),
    )


def newest_first(logs: DataFrame) -> DataFrame:
    """The reference reads its log list newest first."""
    return logs.orderBy(F.desc("arrival_seq"))


def current_batch(logs: DataFrame, control: DataFrame) -> DataFrame:
    """ST3: only logs of the batch opened by the last ``start_batch`` record.

    The reference deletes older logs on ``start_batch``; here the history is kept
    and the scope is a filter. Every log carries the batch id it was received
    under (P4), so the filter compares against one scalar: the id of the latest
    start (by control timestamp, then id). The scalar is a subquery evaluated
    once; no join.
    """
    starts = (control.filter(F.col("action") == "start_batch")
              .select("id_logging_process",
                      parse_log_time("timestamp").alias("__t")))
    last_id = starts.agg(
        F.max_by("id_logging_process", F.struct(F.col("__t"), F.col("id_logging_process")))
    ).scalar()
    return logs.filter(F.col("id_logging_process") == last_id)
