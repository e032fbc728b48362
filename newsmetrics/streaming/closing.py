"""ST4 / ST5 as a stream: batches close by event-time timers (``transformWithState``).

The source tells of each message twice, when it enters a queue and when it has been handled; rows
are (id_logging_process, t, kind 'sent' / 'handled', action). State per batch: the number of
waiting messages, the last handling, the handled end_batch_received, and the changes that
the watermark has not passed yet, summed up per instant and packed into blocks: state is asked
once per block of changes and not once per change. A change counts only once the watermark
has passed its instant, so records may arrive in any order within the watermark's delay and
the outcome equals ``control.batch_closings`` up to the watermark. State per batch is a few
numbers and the changes of one delay; a closed batch keeps its closing instant only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.control import IDLE_TIMEOUT_S
from ..session import checkpoint_path

#: ``transformWithState`` keeps its state in this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECORD = "id_logging_process long, action string, timestamp string, reason string"
PROGRESS = "waiting long, last long, ended long, emptied long, closed long"  # instants in microseconds, -1: none
#: What happens at an instant (microseconds): messages that come less those handled, whether one, an end, is handled.
CHANGE = np.dtype([("t", "<i8"), ("waiting", "<i8"), ("handled", "?"), ("ended", "?")])
BLOCK = 10_000  # changes in a block of state


def summed(changes: np.ndarray) -> np.ndarray:
    """One change per instant, in order of time."""
    t, first = np.unique(np.sort(changes["t"]), return_index=True)
    out = np.zeros(len(t), CHANGE)
    if len(t):
        changes = changes[np.argsort(changes["t"], kind="stable")]
        out["t"] = t
        out["waiting"] = np.add.reduceat(changes["waiting"], first)
        for flag in ("handled", "ended"):
            out[flag] = np.logical_or.reduceat(changes[flag], first)
    return out


class BatchCloser(StatefulProcessor):
    """One logging batch."""

    def __init__(self, gap_s: int = IDLE_TIMEOUT_S):
        self.gap = gap_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", PROGRESS)
        self.pending = handle.getListState("pending", "changes binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        progress = self._load()
        for chunk in rows:
            if progress["closed"] >= 0:
                continue
            micros = chunk["t"].astype("datetime64[us]").astype("int64")
            handled = chunk["kind"] == "handled"
            ended = handled & (chunk["action"] == "end_batch_received")
            changes = np.zeros(len(chunk), CHANGE)
            changes["t"], changes["waiting"] = micros, 1 - 2 * handled.astype(int)
            changes["handled"], changes["ended"] = handled, ended
            self._keep(summed(changes))
        yield from self._advance(key, progress, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, self._load(), timerValues)

    def _keep(self, changes: np.ndarray) -> None:
        for at in range(0, len(changes), BLOCK):
            self.pending.appendValue((changes[at:at + BLOCK].tobytes(),))

    def _pending(self) -> np.ndarray:
        blocks = [np.frombuffer(bytes(block), CHANGE) for (block,) in self.pending.get()]
        return summed(np.concatenate(blocks)) if blocks else np.zeros(0, CHANGE)

    def _load(self) -> dict[str, int]:
        names = [c.split()[0] for c in PROGRESS.split(", ")]
        return dict(zip(names, self.progress.get() if self.progress.exists() else (0, -1, -1, -1, -1)))

    def _closes(self, p: dict[str, int]) -> int | None:
        """The instant from which the batch may close if nothing else happens."""
        if p["waiting"] or p["emptied"] < 0:
            return None
        may = [max(p["ended"], p["emptied"])] if p["ended"] >= 0 else []
        may += [max(p["last"] + self.gap, p["emptied"])] if p["last"] >= 0 else []
        return min(may, default=None)

    def _advance(self, key, p: dict[str, int], timerValues) -> Iterator[pd.DataFrame]:
        """Apply the changes that the watermark has passed; close, or wait for the next instant."""
        if p["closed"] >= 0:
            return
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        changes = self._pending()
        done = 0
        for t, waiting, handled, ended in changes[:np.searchsorted(changes["t"], passed, "right")].tolist():
            closes = self._closes(p)
            if closes is not None and closes < t:
                break
            done += 1
            before = p["waiting"]
            p["waiting"] += waiting
            p["last"] = t if handled else p["last"]
            p["ended"] = t if ended and p["ended"] < 0 else p["ended"]
            if p["waiting"] == 0 and (before or p["emptied"] < 0):
                p["emptied"] = t
        closes = self._closes(p)
        left = changes["t"][done:done + 1].tolist()
        if closes is not None and closes <= passed and not (left and left[0] <= closes):
            p["closed"] = closes
            self.pending.clear()
            reason = "end_received" if 0 <= p["ended"] <= closes else "idle"
            stamp = pd.Timestamp(closes, unit="us").strftime("%Y-%m-%d %H:%M:%S")
            yield pd.DataFrame({"id_logging_process": [int(key[0])], "action": ["end_batch_completed"],
                                "timestamp": [stamp], "reason": [reason]})
        else:
            if done:
                self.pending.clear()
                self._keep(changes[done:])
            wake = min([*left, *([closes] if closes is not None else [])], default=None)
            if wake is not None:  # timers count milliseconds: the first one not before the instant
                self.handle.registerTimer(max(-(-wake // 1000), passed // 1000 + 1))
        self.progress.update(tuple(p.values()))

    def close(self) -> None:
        pass


def closings_stream(events: DataFrame, delay: str = "10 minutes", gap_s: int = IDLE_TIMEOUT_S) -> DataFrame:
    """End records of a stream of queue events; late rows (behind the watermark) are dropped by Spark."""
    timed = events.select("id_logging_process", F.col("t").cast("timestamp").alias("t"), "kind", "action")
    return (timed.withWatermark("t", delay).groupBy("id_logging_process").transformWithStateInPandas(
        statefulProcessor=BatchCloser(gap_s), outputStructType=RECORD, outputMode="append", timeMode="eventTime"))


def start_closing(events: DataFrame, out: str, name: str = "batch_closing", delay: str = "10 minutes",
                  available_now: bool = True):
    """Run the stream into a Parquet folder of control records."""
    spark = events.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, STATE_STORE)
    try:
        w = (closings_stream(events, delay).writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint_path(spark, f"{name}/ckpt")))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
        return w.start()
    finally:
        spark.conf.set(setting, before)
