"""Live progress, running counters and series.

Running (ordered) computations over logs never put a whole outlet into one window
partition: they use the blocked prefix-sum / lag helpers of ``windows``, which
split each outlet's order into fixed-size blocks, aggregate per block, and
carry block offsets over a small per-block table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import elapsed_seconds, format_log_time
from ..functions.numeric import safe_div
from . import windows


def live_progress(typed_logs: DataFrame) -> DataFrame:
    """A14-A16 (batch form of ST7): progress snapshot per outlet.

    Counters count every log (no URL dedup). The mean is the exact mean of the
    positive durations: the reference's step-rounded running mean is not
    associative, and it skips non-positive durations (see README, deviations).
    The rate divides by minutes between the first start and the last update.
    """
    g = typed_logs.groupBy("medio").agg(
        F.count_if(F.col("status") == "success").cast("long").alias("total_articulos_exitosos"),
        F.count_if(F.col("status") != "success").cast("long").alias("total_articulos_fallidos_ns"),
        F.count_if(F.col("status").isNull()).cast("long").alias("__null_status"),
        F.avg(F.when(F.col("dur_ms") > 0, F.col("dur_ms"))).alias("__avg"),
        F.min("start_ts").alias("__t0"),
        F.max("finish_ts").alias("__t1"),
    )
    total = (F.col("total_articulos_exitosos") + F.col("total_articulos_fallidos_ns")
             + F.col("__null_status"))
    minutes = elapsed_seconds("__t0", "__t1") / 60.0
    return g.select(
        "medio",
        "total_articulos_exitosos",
        (F.col("total_articulos_fallidos_ns") + F.col("__null_status")).alias(
            "total_articulos_fallidos"),
        F.coalesce(F.col("__avg"), F.lit(0.0)).alias("duracion_promedio_ms"),
        F.when(minutes > 0, total / minutes).otherwise(F.lit(0.0)).alias("articulos_por_minuto"),
        F.coalesce(format_log_time("__t1"), F.lit("")).alias("ultima_actualizacion"),
        F.coalesce(format_log_time("__t0"), F.lit("")).alias("start_time"),
    )


def running_progress(typed_logs: DataFrame, block_size: int = 1 << 16) -> DataFrame:
    """Counters after each log, per outlet, in arrival order.

    Output: medio, arrival_seq, status, ok_so_far, fail_so_far, mean_ms_so_far,
    rate_per_min_so_far (relative to the outlet's first start).
    """
    base = typed_logs.select(
        "medio", "arrival_seq", "status", "start_ts", "finish_ts",
        (F.col("status") == "success").cast("long").alias("__ok"),
        (F.col("status") != "success").cast("long").alias("__ko_ns"),
        F.col("status").isNull().cast("long").alias("__ko_null"),
        F.when(F.col("dur_ms") > 0, F.col("dur_ms")).otherwise(F.lit(0.0)).alias("__d"),
        (F.col("dur_ms") > 0).cast("long").alias("__dn"),
    ).fillna(0, subset=["__ok", "__ko_ns", "__dn"])
    run = windows.running_sums(
        base, keys=["medio"], order="arrival_seq",
        sums={"ok_so_far": "__ok", "__ko1": "__ko_ns", "__ko2": "__ko_null",
              "__dsum": "__d", "__dcnt": "__dn"},
        block_size=block_size)
    # the progress start time is fixed per outlet: one row per outlet, joined back
    t0 = typed_logs.groupBy("medio").agg(F.min("start_ts").alias("__t0"))
    run = run.join(t0, "medio", "left")
    fail = F.col("__ko1") + F.col("__ko2")
    minutes = elapsed_seconds("__t0", "finish_ts") / 60.0
    return run.select(
        "medio", "arrival_seq", "status",
        F.col("ok_so_far").cast("long").alias("ok_so_far"),
        fail.cast("long").alias("fail_so_far"),
        safe_div(F.col("__dsum"), F.col("__dcnt")).alias("mean_ms_so_far"),
        F.when(minutes > 0, (F.col("ok_so_far") + fail) / minutes)
         .otherwise(F.lit(0.0)).alias("rate_per_min_so_far"),
    )


def backlog(typed_logs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Tasks started minus tasks finished over time, per outlet.

    Each log is +1 at its start and -1 at its finish (when those parse); the
    backlog after each change point is a running sum in time order, over blocks
    that hold equal shares of the rows however they crowd in time.
    """
    starts = typed_logs.filter(F.col("start_ts").isNotNull()).select(
        "medio", F.col("start_ts").alias("t"), F.col("arrival_seq"), F.lit(0).alias("kind"),
        F.lit(1).cast("long").alias("delta"))
    ends = typed_logs.filter(F.col("finish_ts").isNotNull() & F.col("start_ts").isNotNull()) \
        .select("medio", F.col("finish_ts").alias("t"), F.col("arrival_seq"),
                F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("delta"))
    run = windows.ordered_sums(starts.unionByName(ends), ["medio"], ["t", "kind", "arrival_seq"],
                               {"backlog": "delta"}, ranges)
    return run.select("medio", format_log_time("t").alias("t"), "kind", "arrival_seq", "backlog")


def coverage(crawl: DataFrame, typed_logs: DataFrame) -> DataFrame:
    """Crawled rows vs successfully scraped URLs per outlet.

    A union of two tagged projections aggregated once: no join, no cross
    product, partial aggregation on both inputs. ``crawl`` has (medio, url);
    the scraped side counts distinct URLs whose A2 status is success.
    """
    from .metrics import url_status
    ok = (url_status(typed_logs).filter(F.col("status") == "success")
          .filter(F.col("url").isNotNull() & (F.col("url") != ""))
          .select("medio", F.lit(0).cast("long").alias("c"), F.lit(1).cast("long").alias("s")))
    cr = crawl.select("medio", F.lit(1).cast("long").alias("c"), F.lit(0).cast("long").alias("s"))
    g = cr.unionByName(ok).groupBy("medio").agg(
        F.sum("c").alias("crawled"), F.sum("s").alias("scraped_ok"))
    return g.select(
        "medio", "crawled", "scraped_ok",
        (F.col("crawled") - F.col("scraped_ok")).alias("pending"),
        F.try_divide(F.col("scraped_ok").cast("double"), F.col("crawled").cast("double"))
         .alias("ok_ratio"))


def coverage_total(per_outlet: DataFrame, name: str = "*") -> DataFrame:
    """A19 / A20 over all outlets: one row under the outlet ``name``."""
    g = per_outlet.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("crawled", "scraped_ok", "pending")])
    return g.select(F.lit(name).alias("medio"), "crawled", "scraped_ok", "pending",
                    F.try_divide(F.col("scraped_ok").cast("double"), F.col("crawled").cast("double")).alias("ok_ratio"))


def missing_urls(crawl: DataFrame, typed_logs: DataFrame) -> DataFrame:
    """J3 row form: crawled URLs of an outlet with no successful scrape."""
    from .metrics import url_status
    ok = url_status(typed_logs).filter(F.col("status") == "success").select("medio", "url")
    return crawl.join(ok, ["medio", "url"], "left_anti")


def crawl_progress_pct(done, total):
    """100*done/total, 0 when total is 0 (rounded to 1 place only on export, MA2)."""
    return F.when(total > 0, done / total * 100.0).otherwise(F.lit(0.0))


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def polled_changes(changes: DataFrame, sums: dict[str, str], step_s: int = 60) -> DataFrame:
    """ST9: running totals at the polls, one every ``step_s`` seconds, by which they changed.

    ``changes`` has (medio, t, <delta columns>). Polls are taken at every whole
    minute (or step) from the outlet's first change (rounded down) to its last; a change at
    exactly a poll's minute is seen by it. A poll is named only if a change fell
    into the minute before it, so the result has at most one row per outlet and
    minute with changes, whatever the number of logs and however long the outlet
    was silent; the windows over it run on that small table.

    Columns: medio, poll, first, last (minutes or steps since 1970), ``sums`` and their deltas.
    """
    step = step_s * 1_000_000
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col("t"))
    inside = F.pmod(micros, F.lit(step))
    down = ((micros - inside) / step).cast("long")
    per_minute = (changes.withColumn("__down", down)
                  .withColumn("poll", F.col("__down") + (inside > 0).cast("long"))
                  .groupBy("medio", "poll")
                  .agg(*[F.sum(F.col(d).cast("long")).alias(d) for d in sums.values()],
                       F.min("__down").alias("__a"), F.max("__down").alias("__z")))
    whole, so_far = Window.partitionBy("medio"), Window.partitionBy("medio").orderBy("poll")
    return (per_minute.select(
        "medio", "poll", F.min("__a").over(whole).alias("first"), F.max("__z").over(whole).alias("last"),
        *sums.values(), *[F.sum(d).over(so_far).alias(out) for out, d in sums.items()])
        .where("poll <= last"))


def _minute(c: Column, step_s: int = 60) -> Column:
    return format_log_time(F.timestamp_add("SECOND", c * step_s, F.expr(_EPOCH)))


def counter_changes(typed_logs: DataFrame) -> DataFrame:
    """Success / failure increments at each log's time (start, else finish)."""
    t = F.coalesce("start_ts", "finish_ts")
    return typed_logs.filter(t.isNotNull()).select(
        "medio", t.alias("t"), F.col("arrival_seq").alias("seq"),
        (F.col("status") == "success").cast("long").alias("d_ok"),
        F.coalesce((F.col("status") != "success"), F.lit(True)).cast("long").alias("d_ko"))


def dashboard_series(typed_logs: DataFrame, step_s: int = 60) -> DataFrame:
    """W3 / ST9: the chart's points: polls whose (success, errors) changed."""
    polls = polled_changes(counter_changes(typed_logs), {"exitosos": "d_ok", "fallidos": "d_ko"}, step_s)
    return polls.where("d_ok <> 0 OR d_ko <> 0").select(
        "medio", _minute(F.col("poll"), step_s).alias("t"), "exitosos", "fallidos")


def backlog_deltas(typed_logs: DataFrame) -> DataFrame:
    starts = typed_logs.filter(F.col("start_ts").isNotNull()).select(
        "medio", F.col("start_ts").alias("t"), F.col("arrival_seq").alias("seq"),
        F.lit(1).cast("long").alias("delta"))
    ends = typed_logs.filter(F.col("finish_ts").isNotNull() & F.col("start_ts").isNotNull()) \
        .select("medio", F.col("finish_ts").alias("t"), (-F.col("arrival_seq") - 1).alias("seq"),
                F.lit(-1).cast("long").alias("delta"))
    return starts.unionByName(ends)


def backlog_stalls(typed_logs: DataFrame, polls: int = 10) -> DataFrame:
    """Backlog unchanged for at least ``polls`` consecutive minute polls.

    A run of equal polls begins at the first poll and at every poll whose net
    change is not zero, and ends before the next begin; its length is the
    distance, so silent minutes cost nothing.
    """
    changed = polled_changes(backlog_deltas(typed_logs), {"backlog": "delta"})
    begins = changed.where("delta <> 0 OR poll = first").select("medio", "poll", "last", "backlog")
    # the first poll begins a run even if no change falls on it
    opening = (changed.groupBy("medio").agg(F.min("first").alias("poll"), F.max("last").alias("last"),
                                            F.min("poll").alias("__p"))
               .where("__p > poll").select("medio", "poll", "last", F.lit(0).cast("long").alias("backlog")))
    order = Window.partitionBy("medio").orderBy("poll")
    runs = (begins.unionByName(opening)
            .select("medio", "poll", "backlog", F.row_number().over(order).cast("long").alias("island"),
                    F.coalesce(F.lead("poll").over(order) - 1, F.col("last")).alias("until"))
            .withColumn("polls", F.col("until") - F.col("poll") + 1).where(F.col("polls") >= polls))
    return runs.select("medio", "island", _minute(F.col("poll")).alias("first"), _minute(F.col("until")).alias("last"),
                       "backlog", "polls")
