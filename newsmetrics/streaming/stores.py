"""Streams over versioned tables: redelivered logs (ST8), sent URLs (ST6), live counters with resets (K7, K8).

All sinks run in ``foreachBatch``. Each change is one version of its table and carries the epoch, so a
replayed epoch finds that it has been merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import scrape_log
from ..session import checkpoint_path
from ..sources import io
from ..sources.versioned import VersionedTable, first_of_key, merge_sink

# ------------------------------------------------------------------ ST8: logs

#: What makes two deliveries the same log.
LOG_KEY = ["id_logging_process", "medio", "url", "starting_time"]


def log_table(spark: SparkSession, path: str, buckets: int = 64) -> VersionedTable:
    """Raw scrape logs (D8), once each whatever their deliveries."""
    return VersionedTable(spark, path, schemas.SCRAPE_LOG_RAW, LOG_KEY, buckets)


def start_log_merge(logs: DataFrame, table: VersionedTable, name: str, available_now: bool = True):
    """ST8: logs of a stream into ``table``; of equal deliveries the first to arrive stays."""
    w = (logs.writeStream.option("checkpointLocation", checkpoint_path(table.spark, f"{name}/ckpt"))
         .foreachBatch(merge_sink(table, first_of_key(LOG_KEY, "arrival_seq"))))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


# ------------------------------------------------------------------ ST6: URLs

class UrlMemory:
    """All URLs ever sent: an exact table in hash buckets behind Bloom filters.

    A shard of URLs has a filter of ``bits`` bits, kept as rows (shard, word, 64 bits). A
    lookup asks the words of its URLs; only URLs whose ``hashes`` bits are all set are looked up, in
    the buckets that such URLs fall into. Fuller filters let more URLs through to the table, never
    fewer. The filters are extended before the table, so they hold at least its URLs.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, bits: int = 1 << 22, hashes: int = 5):
        self.urls = VersionedTable(spark, f"{path}/urls", "url string, sent_at timestamp", ["url"], buckets)
        self.filters = VersionedTable(spark, f"{path}/filters", "shard int, word int, bits long", ["shard"], buckets)
        self.bits, self.hashes = bits, hashes

    def _asked(self, urls: DataFrame) -> DataFrame:
        """(url, shard, word, bit) of every position of every URL."""
        at = urls.select("url", F.explode(F.sequence(F.lit(0), F.lit(self.hashes - 1))).alias("k")).select(
            "url", F.pmod(F.xxhash64("url", "k"), F.lit(self.bits)).cast("int").alias("at"))
        return at.select("url", self.urls.bucket().alias("shard"), (F.col("at") / 64).cast("int").alias("word"),
                         F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64).alias("bit"))

    def known(self, urls: DataFrame) -> DataFrame:
        """Those of ``urls`` (distinct, column url) that have been sent."""
        asked = self._asked(urls)
        shards = [r[0] for r in asked.select(self.filters.bucket()).distinct().collect()]  # at most ``buckets``
        words = self.filters.read(buckets=shards)
        may = (asked.join(words, ["shard", "word"]).where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
               .groupBy("url").agg(F.count("*").alias("n")).where(F.col("n") == self.hashes).select("url").persist())
        try:
            buckets = [r[0] for r in may.select(self.urls.bucket()).distinct().collect()]
            return may.join(self.urls.read(buckets=buckets).select("url"), "url", "left_semi").checkpoint()
        finally:
            may.unpersist()

    def add(self, urls: DataFrame, notes: dict | None = None) -> None:
        """Remember (url, sent_at); a URL keeps its first time."""
        def united(old: DataFrame, new: DataFrame) -> DataFrame:
            return old.unionByName(new).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))

        words = self._asked(urls).groupBy("shard", "word").agg(F.bit_or("bit").alias("bits"))
        self.filters.merge(words, united)
        self.urls.merge(urls, first_of_key(["url"], "sent_at"), notes)

    def send(self, batch: DataFrame, epoch: int, out: str) -> None:
        """Write the tasks of ``batch`` (url, sent_at, ...) whose URL has never been sent, and remember them.

        One task per URL goes out, the first in time; tasks without a URL go nowhere. The output of
        an epoch is written before its URLs are remembered; an epoch that has been remembered is not sent again.
        """
        if self.urls.version()["notes"].get("epoch", -1) >= epoch:
            return
        rest = [c for c in batch.columns if c != "url"]
        first = batch.where(F.col("url").isNotNull()).groupBy("url").agg(F.min_by(F.struct(*rest), F.struct("sent_at", F.xxhash64(*rest))).alias("t"))
        tasks = first.select("url", *[F.col("t")[c].alias(c) for c in rest]).checkpoint()
        fresh = tasks.join(self.known(tasks.select("url")), "url", "left_anti").checkpoint()
        io.append_log(fresh, out, epoch)
        self.add(fresh.select("url", F.col("sent_at").cast("timestamp").alias("sent_at")), {"epoch": epoch})
        for t in (self.urls, self.filters):
            t.vacuum()


def start_sending(tasks: DataFrame, memory: UrlMemory, out: str, name: str, limit: str = "1 hour",
                  available_now: bool = True):
    """ST6 / J7: each URL of a stream of tasks is sent once.

    The stream's state remembers URLs for ``limit`` of event time (``sent_at``, which must not fall behind by
    more), so its size follows the rate and not the age of the stream; older URLs are found in ``memory``.
    """
    recent = tasks.withWatermark("sent_at", limit).dropDuplicatesWithinWatermark(["url"])
    w = (recent.writeStream.option("checkpointLocation", checkpoint_path(memory.urls.spark, f"{name}/ckpt"))
         .foreachBatch(lambda df, epoch: memory.send(df, epoch, out)))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


# ------------------------------------------------------------------ K7 / K8: live counters

COUNTERS = ("medio string, exitosos long, fallidos long, dur_sum double, dur_n long, "
            "started timestamp_ntz, updated timestamp_ntz, reset_seq long")


def counted(logs: DataFrame, resets: DataFrame) -> DataFrame:
    """Per outlet: counters over the logs after its last reset marker; all of them without one.

    ``logs``: the typed view of scrape logs; ``resets``: (medio, seq). Logs of the seq of a marker
    or before it do not count. Outlets that only have a marker get zeros.
    """
    marks = resets.groupBy("medio").agg(F.max("seq").alias("reset_seq"))
    rows = logs.join(marks, "medio", "full")
    live = F.col("arrival_seq").isNotNull() & (F.col("reset_seq").isNull() | (F.col("arrival_seq") > F.col("reset_seq")))
    ok = live & F.coalesce(F.col("status") == "success", F.lit(False))
    return rows.groupBy("medio").agg(
        F.count_if(ok).alias("exitosos"), F.count_if(live & ~ok).alias("fallidos"),
        F.coalesce(F.sum(F.when(live & (F.col("dur_ms") > 0), F.col("dur_ms"))), F.lit(0.0)).alias("dur_sum"),
        F.count_if(live & F.coalesce(F.col("dur_ms") > 0, F.lit(False))).alias("dur_n"),
        F.min(F.when(live, F.col("start_ts"))).alias("started"), F.max(F.when(live, F.col("finish_ts"))).alias("updated"),
        F.max("reset_seq").alias("reset_seq"))


def add_counters(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counters of earlier batches plus those of a batch; a reset in the batch drops the earlier ones."""
    both = old.withColumn("late", F.lit(False)).unionByName(new.withColumn("late", F.lit(True)))
    mark = F.max(F.when(F.col("late"), F.col("reset_seq")))
    g = both.groupBy("medio").agg(mark.alias("mark"), F.max("reset_seq").alias("reset_seq"),
                                  *[f(F.when(F.col("late") == late, F.col(c))).alias(f"{c}_{late}") for late in (True, False)
                                    for c, f in _COUNTED.items()])

    def joined(c: str) -> Column:
        kept, own = F.when(F.col("mark").isNull(), F.col(f"{c}_False")), F.col(f"{c}_True")
        if _COUNTED[c] is F.sum:
            return F.coalesce(kept, F.lit(0)) + F.coalesce(own, F.lit(0))
        return F.least(kept, own) if _COUNTED[c] is F.min else F.greatest(kept, own)

    return g.select("medio", *[joined(c).alias(c) for c in _COUNTED], "reset_seq")


_COUNTED = {"exitosos": F.sum, "fallidos": F.sum, "dur_sum": F.sum, "dur_n": F.sum, "started": F.min, "updated": F.max}


def counter_table(spark: SparkSession, path: str, buckets: int = 1) -> VersionedTable:
    return VersionedTable(spark, path, COUNTERS, ["medio"], buckets)


def count_into(table: VersionedTable, logs: DataFrame, resets: DataFrame, epoch: int, keep: int = 2) -> None:
    """K7 / K8: add one micro-batch to the running counters, once. Rows within a batch are in order of
    their seq; batches come in order. ``keep`` versions stay readable."""
    if table.version()["notes"].get("epoch", -1) >= epoch:
        return
    table.merge(counted(logs, resets).checkpoint(), add_counters, {"epoch": epoch})
    table.vacuum(keep)


#: A record of the log stream with this status restarts its outlet's counters.
RESET = "reset_progress"


def start_feed(logs: DataFrame, table: VersionedTable, name: str, interval: str = "1 second", keep: int = 10,
               available_now: bool = False):
    """ST9 / ST7: publish the counters of a stream of raw logs (D8) every ``interval``.

    Each trigger with records makes one version of ``table``: a whole snapshot of all outlets, which
    readers take by its number; the last ``keep`` snapshots stay. Records of status ``RESET`` are
    markers and count as no article.
    """
    def publish(batch: DataFrame, epoch: int) -> None:
        marker = F.coalesce(F.col("status") == RESET, F.lit(False))
        batch = batch.persist()
        try:
            resets = batch.where(marker).select("medio", F.col("arrival_seq").alias("seq"))
            count_into(table, scrape_log.typed(batch.where(~marker)), resets, epoch, keep)
        finally:
            batch.unpersist()

    w = logs.writeStream.option("checkpointLocation", checkpoint_path(table.spark, f"{name}/ckpt")).foreachBatch(publish)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def progress_snapshot(counters: DataFrame) -> DataFrame:
    """D13 rows of the counters: what the dashboard reads."""
    minutes = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("updated")).cast("double") / 60e6
    text = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return counters.select(
        "medio", F.col("exitosos").alias("total_articulos_exitosos"), F.col("fallidos").alias("total_articulos_fallidos"),
        F.when(F.col("dur_n") > 0, F.col("dur_sum") / F.col("dur_n")).otherwise(F.lit(0.0)).alias("duracion_promedio_ms"),
        F.when(minutes > 0, (F.col("exitosos") + F.col("fallidos")) / minutes).otherwise(F.lit(0.0)).alias("articulos_por_minuto"),
        text("updated").alias("ultima_actualizacion"), text("started").alias("start_time"))
