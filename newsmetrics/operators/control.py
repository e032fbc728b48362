"""Control and error logs (P2, P3, F5, F6, DT7, ST3-ST5 in batch form).

Batches close (``batch_closings``) when their end was received, or nothing was handled
for the idle timeout, and no message waits in a queue.

Idle sessions (ST5) are aggregated per stretch of the timeout before their order
is taken, so a log without grouping key is not one window partition;
``session_window`` is used where the stream is keyed (streaming module).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import elapsed_seconds, format_log_time, parse_log_time
from . import windows

# ---- fixed values: control actions and accepted error origins ---------------
CONTROL_ACTIONS = ["start_batch", "end_batch_received", "end_batch_completed"]
ERROR_ORIGINS = ["scheduler", "crawler"]
IDLE_TIMEOUT_S = 120
# ---- end of fixed values ------------------------------------------------------


def control_record(df: DataFrame, id_col: str, action_col: str, ts_col: str) -> DataFrame:
    """Control records; actions outside the three known ones are dropped."""
    return (df.select(F.col(id_col).cast("long").alias("id_logging_process"),
                      F.col(action_col).alias("action"),
                      format_log_time(ts_col).alias("timestamp"))
            .filter(F.col("action").isin(CONTROL_ACTIONS)))


def error_record(df: DataFrame) -> DataFrame:
    """Error records with '' for a null outlet/stage, split by origin whitelist.

    Input columns: origen, error_ts (timestamp), error_detail, arg_medio, etapa,
    id_logging_process. Output adds ``accepted`` ('accepted' / 'rejected'):
    rejected rows are kept for quarantine instead of raising.
    """
    return df.select(
        F.col("origen").alias("from"),
        F.coalesce(F.col("arg_medio"), F.lit("")).alias("arg_medio"),
        format_log_time("error_ts").alias("error_timestamp"),
        F.coalesce(F.col("etapa"), F.lit("")).alias("stage"),
        F.col("error_detail").cast("string").alias("error_detail"),
        F.col("id_logging_process").cast("long").alias("id_logging_process"),
        F.when(F.col("origen").isin(ERROR_ORIGINS), F.lit("accepted"))
         .otherwise(F.lit("rejected")).alias("accepted"),
    )


def batch_lifecycle(control: DataFrame) -> DataFrame:
    """ST4: one row per batch id with start / end-received / end-completed times.

    Aggregation by batch id (partial+final); a batch is ``completed`` once its
    end_batch_completed record exists.
    """
    t = parse_log_time("timestamp")
    g = control.groupBy("id_logging_process").agg(
        F.min(F.when(F.col("action") == "start_batch", t)).alias("__s"),
        F.max(F.when(F.col("action") == "end_batch_received", t)).alias("__r"),
        F.max(F.when(F.col("action") == "end_batch_completed", t)).alias("__c"),
    )
    return g.select(
        "id_logging_process",
        format_log_time("__s").alias("started"),
        format_log_time("__r").alias("end_received"),
        format_log_time("__c").alias("end_completed"),
        elapsed_seconds("__s", "__c").alias("duracion_segundos"),
        F.when(F.col("__c").isNotNull(), F.lit("completed")).otherwise(F.lit("open"))
         .alias("status"),
    )


def idle_sessions(events: DataFrame, ts: str = "ts", gap_s: int = IDLE_TIMEOUT_S) -> DataFrame:
    """ST5: a new batch starts after more than ``gap_s`` seconds without messages.

    Matches ``session_window(ts, '120 seconds')``: an event exactly 120 s after
    the previous one stays in the session, 121 s opens a new one. Events within
    one stretch of ``gap_s`` seconds can't be apart by more, so they are first
    aggregated (map-side) to one row per stretch; the order is then taken over
    that table, whose size follows the time span and not the number of events.
    """
    t = F.col(ts).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), t)
    size = gap_s * 1_000_000
    stretch = ((micros - F.pmod(micros, F.lit(size))) / size).cast("long")
    rows = (events.where(t.isNotNull()).groupBy(stretch.alias("stretch"))
            .agg(F.min(t).alias("a"), F.max(t).alias("b"), F.count(F.lit(1)).alias("n")))
    order = Window.orderBy("stretch")
    apart = F.timestamp_diff("MICROSECOND", F.lag("b").over(order), F.col("a")) > size
    numbered = (rows.withColumn("new", F.coalesce(apart, F.lit(True)).cast("long"))
                .withColumn("session", F.sum("new").over(order)))
    g = numbered.groupBy("session").agg(F.min("a").alias("__a"), F.max("b").alias("__b"), F.sum("n").alias("n_events"))
    return g.select(
        "session",
        format_log_time("__a").alias("session_start"),
        format_log_time(F.timestamp_add("SECOND", F.lit(gap_s), F.col("__b"))).alias("session_end"),
        "n_events")


def quiet_windows(activity: DataFrame, keys: list[str], gap_s: int = IDLE_TIMEOUT_S) -> DataFrame:
    """(keys, opens, shuts): from ``gap_s`` after an activity to the next one, if that is later.

    ``activity`` has the keys and t; the last window of a key has no end (null). As in
    ``idle_sessions`` the order is taken over one row per key and stretch of the timeout.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("t"))
    stretch = F.floor(micros / (gap_s * 1_000_000)).cast("long")
    rows = activity.groupBy(*keys, stretch.alias("stretch")).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    after = F.lead("a").over(Window.partitionBy(*keys).orderBy("stretch"))
    w = rows.select(*keys, F.timestamp_add("SECOND", F.lit(gap_s), F.col("b")).alias("opens"), after.alias("shuts"))
    return w.where(F.col("shuts").isNull() | (F.col("shuts") > F.col("opens")))


def batch_closings(messages: DataFrame, until: Column | None = None, gap_s: int = IDLE_TIMEOUT_S,
                   ranges: int | None = None) -> DataFrame:
    """ST4 / ST5: the end_batch_completed record of every batch that closes, with its reason.

    ``messages``: id_logging_process, sent, handled (null: still in its queue), action (null for
    logs). A batch closes at the first instant at which its queues are empty (every message sent so far
    is handled) and either an end_batch_received has been handled or the last handling is more
    than ``gap_s`` seconds past. Both conditions are counters that change at instants: +1 / -1 as
    messages come and go, and as idle windows open and shut; the changes are summed up per batch and
    instant before the shuffle, and one ordered sum over them, cut by row counts, gives both. Idle
    closings carry the instant from which the condition holds (last handling plus the timeout). A batch
    whose instant lies after ``until`` is still open and has no record.
    """
    key = F.col("id_logging_process")
    one, none, minus = (F.lit(n).cast("long") for n in (1, 0, -1))
    handled = messages.where(F.col("handled").isNotNull())
    quiet = quiet_windows(handled.select(key, F.col("handled").alias("t")), ["id_logging_process"], gap_s)
    ended = (handled.where(F.col("action") == "end_batch_received").groupBy(key).agg(F.min("handled").alias("received")))
    parts = [messages.where(F.col("sent").isNotNull()).select(key, F.col("sent").alias("t"), one.alias("waiting"), none.alias("may")),
             handled.where(F.col("sent").isNotNull()).select(key, F.col("handled").alias("t"), minus.alias("waiting"), none.alias("may")),
             quiet.select(key, F.col("opens").alias("t"), none.alias("waiting"), one.alias("may")),
             quiet.where(F.col("shuts").isNotNull()).select(key, F.col("shuts").alias("t"), none.alias("waiting"), minus.alias("may")),
             ended.select(key, F.col("received").alias("t"), none.alias("waiting"), one.alias("may"))]
    changes = parts[0]
    for p in parts[1:]:
        changes = changes.unionByName(p)
    instants = changes.groupBy("id_logging_process", "t").agg(F.sum("waiting").alias("waiting"), F.sum("may").alias("may"))
    run = windows.ordered_sums(instants, ["id_logging_process"], ["t"], {"queued": "waiting", "closable": "may"}, ranges)
    first = run.where("queued = 0 AND closable > 0").groupBy("id_logging_process").agg(F.min("t").alias("closed"))
    if until is not None:
        first = first.where(F.col("closed") <= until)
    reason = F.when(F.col("received") <= F.col("closed"), F.lit("end_received")).otherwise(F.lit("idle"))
    return first.join(ended, "id_logging_process", "left").select(
        "id_logging_process", F.lit("end_batch_completed").alias("action"), format_log_time("closed").alias("timestamp"),
        reason.alias("reason"), "closed")


def closed_lifecycle(messages: DataFrame, closings: DataFrame) -> DataFrame:
    """ST4 with derived closings: per batch its times, why it closed, and what it did not take.

    ``handled`` counts the messages taken until the batch closed, ``left`` those that came or
    waited beyond.
    """
    m = messages.join(closings.select("id_logging_process", "closed", "reason"), "id_logging_process", "left")
    taken = F.col("handled").isNotNull() & (F.col("closed").isNull() | (F.col("handled") <= F.col("closed")))
    g = m.groupBy("id_logging_process").agg(
        F.min(F.when(F.col("action") == "start_batch", F.col("handled"))).alias("s"),
        F.min(F.when(F.col("action") == "end_batch_received", F.col("handled"))).alias("r"),
        F.max("closed").alias("c"), F.max("reason").alias("reason"),
        F.count_if(taken).alias("handled"), F.count_if(~taken).alias("left"))
    return g.select("id_logging_process", format_log_time("s").alias("started"), format_log_time("r").alias("end_received"),
                    format_log_time("c").alias("end_completed"), "reason",
                    F.when(F.col("c").isNotNull(), F.lit("completed")).otherwise(F.lit("open")).alias("status"),
                    "handled", "left")
