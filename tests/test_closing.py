"""ST4 / ST5: closing batches, as a table and as a stream."""
import os
import random
import tempfile
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from newsmetrics.operators import control as C
from newsmetrics.operators import windows
from newsmetrics.plans import derived as D
from newsmetrics.streaming import closing
from tests.conftest import SF_SMALL

T0 = datetime(2025, 1, 1)
SCHEMA = "id_logging_process long, sent timestamp_ntz, handled timestamp_ntz, action string"


def at(s):
    return None if s is None else T0 + timedelta(seconds=s)


def rows(messages):
    return [(i, at(s), at(h), a) for i, s, h, a in messages]


def plain(messages, gap=120.0):
    """Closing instants by looking at every instant at which something can change."""
    out = {}
    for batch in {m[0] for m in messages}:
        own = [m for m in messages if m[0] == batch]
        handled = sorted(m[2] for m in own if m[2] is not None)
        ended = min((m[2] for m in own if m[3] == "end_batch_received" and m[2] is not None), default=None)
        for t in sorted({x for m in own for x in m[1:3] if x is not None} | {h + gap for h in handled}):
            waiting = sum(m[1] <= t and (m[2] is None or m[2] > t) for m in own)
            last = max((h for h in handled if h <= t), default=None)
            idle = last is not None and t - last >= gap and not any(h == t for h in handled)
            if not waiting and (ended is not None and ended <= t or idle):
                out[batch] = (t, "end_received" if ended is not None and ended <= t else "idle")
                break
    return out


CASES = [
    (1, 0, 0, "start_batch"), (1, 5, 6, None), (1, 7, 8, "end_batch_received"),  # end received, queues empty
    (2, 0, 0, "start_batch"), (2, 5, 90, None), (2, 7, 8, "end_batch_received"),  # waits for the backlog
    (3, 0, 0, "start_batch"), (3, 10, 11, None),  # idle
    (4, 0, 0, "start_batch"), (4, 119, 120, None), (4, 240, 240.5, None),  # 120 s exactly, then 120.5 s
    (5, 0, 0, "start_batch"), (5, 1, None, None), (5, 2, 3, "end_batch_received"),  # a message is never handled: open
    (6, 0, 0, "start_batch"), (6, 10, 400, None), (6, 500, 501, None),  # idle only after the late message
    (7, 0, 0, "start_batch"), (7, 300, 301, None)]  # closed by idling, one message left


def random_batches(seed, batches=40):
    rng = random.Random(seed)
    out = []
    for b in range(batches):
        t = 0.0
        for _ in range(rng.randint(1, 25)):
            t += rng.choice((1, 5, 30, 60, 119, 120, 121, 200))
            out.append((b, t, rng.choice((t, t, t + 1, t + 50, t + 150, t + 0.5, None if rng.random() < 0.1 else t)), None))
        if rng.random() < 0.6:
            out.append((b, t + 1, t + 2, "end_batch_received"))
    return out


def closings(spark, messages, until=None):
    df = spark.createDataFrame(rows(messages), SCHEMA)
    got = C.batch_closings(df, None if until is None else F.lit(at(until))).collect()
    return {r["id_logging_process"]: ((r["closed"] - T0).total_seconds(), r["reason"]) for r in got}





def test_named_cases(spark):
    assert closings(spark, CASES) == {1: (8.0, "end_received"), 2: (90.0, "end_received"), 3: (131.0, "idle"),
                                      4: (360.5, "idle"), 6: (621.0, "idle"), 7: (120.0, "idle")}


def test_like_looking_at_every_instant(spark):
    for seed in (1, 2):
        messages = random_batches(seed)
        assert closings(spark, messages) == plain(messages)
    assert closings(spark, CASES, until=100) == {k: v for k, v in plain(CASES).items() if v[0] <= 100}
    assert closings(spark, []) == {}


def test_stream_equals_table(spark):
    tmp = tempfile.mkdtemp(prefix="nm-closing-")
    messages = CASES + [(b + 100, s, h, a) for b, s, h, a in random_batches(3)]
    far = max(m[1] for m in messages) + 3600
    messages.append((999, far, None, None))  # moves the watermark
    df = spark.createDataFrame(rows(messages), SCHEMA)
    events = df.select("id_logging_process", F.col("sent").alias("t"), F.lit("sent").alias("kind"), "action").unionByName(
        df.where("handled is not null").select("id_logging_process", F.col("handled").alias("t"), F.lit("handled").alias("kind"), "action"))
    # four files in order of time, shuffled inside: rows arrive late by less than the delay
    ordered = events.orderBy("t").collect()
    size = -(-len(ordered) // 4)
    for k in range(4):
        part = ordered[k * size:(k + 1) * size]
        random.Random(k).shuffle(part)
        spark.createDataFrame(part, events.schema).coalesce(1).write.parquet(os.path.join(tmp, "in", f"p{k}"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(tmp, "in", "*"))
    q = closing.start_closing(stream, os.path.join(tmp, "out"), name=os.path.basename(tmp), delay="30 minutes")
    q.awaitTermination(300)
    got = spark.read.schema(closing.RECORD).parquet(os.path.join(tmp, "out"))
    until = F.lit(at(far - 1800))
    want = C.batch_closings(df, until).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.count() > 30


class CountedState:
    """List, map and value state of one key that counts how often it is asked."""

    def __init__(self):
        self.asked, self.lists, self.maps, self.value, self.timers = 0, {}, {}, None, []

    def getValueState(self, *_):
        return self

    getListState = getMapState = getValueState

    def registerTimer(self, at):
        self.timers.append(at)

    def __getattribute__(self, name):
        calls = {"exists": lambda s: s.value is not None, "update": lambda s, v: setattr(s, "value", v),
                 "appendValue": lambda s, v: s.lists.setdefault("x", []).append(v), "clear": lambda s: s.lists.clear(),
                 "get": lambda s: s.value if s.value is not None and not s.lists else iter(s.lists.get("x", [])),
                 "containsKey": lambda s, k: k in s.maps, "getValue": lambda s, k: s.maps[k],
                 "updateValue": lambda s, k, v: s.maps.update({k: v}), "removeKey": lambda s, k: s.maps.pop(k),
                 "keys": lambda s: iter(list(s.maps))}
        if name not in calls:
            return object.__getattribute__(self, name)
        self.asked += 1
        return lambda *a: calls[name](self, *a)


def test_stream_asks_its_state_per_block_and_not_per_change():
    state, n = CountedState(), 5_000
    closer = closing.BatchCloser()
    closer.init(state)
    sent = pd.DataFrame({"t": pd.to_datetime([T0 + timedelta(milliseconds=7 * k) for k in range(n)]), "kind": "sent", "action": None})
    handled = sent.assign(t=sent["t"] + pd.Timedelta(milliseconds=3), kind="handled")
    both = pd.concat([handled, sent]).sample(frac=1, random_state=1)
    early = type("Timer", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    assert list(closer.handleInputRows((5,), iter([both[:6_000], both[6_000:]]), early)) == []
    assert state.asked < 20 and len(state.timers) == 1


def test_changes_are_summed_per_instant():
    changes = np.array([(5, -1, True, False), (3, 1, False, False), (5, 1, False, False), (5, -1, True, True), (3, 1, False, False)],
                       closing.CHANGE)
    assert closing.summed(changes).tolist() == [(3, 2, False, False), (5, -1, True, True)]
    assert closing.summed(changes[:0]).tolist() == []


def test_lifecycle_of_derived_batches(spark):
    m = D.queue_messages(spark, "/root/testdata/sf0.01")
    life = C.closed_lifecycle(m, C.batch_closings(m, m.agg(F.max("sent")).scalar()))
    kinds = {(r["status"], r["reason"]): r["n"] for r in life.groupBy("status", "reason").agg(F.count("*").alias("n")).collect()}
    assert set(kinds) == {("completed", "end_received"), ("completed", "idle"), ("open", None)}
    assert min(kinds.values()) > 5 and life.where("left > 0 AND status = 'completed'").count() > 5
    assert life.agg(F.sum(F.col("handled") + F.col("left"))).first()[0] == m.count()
    assert D.queue_messages(spark, SF_SMALL).count() > 1000


def test_ordered_sums_with_all_rows_in_one_second(spark):
    n, ranges = 40_000, 8
    df = spark.range(n).select(F.lit("m").alias("k"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("t"),
                               (n - F.col("id")).alias("seq"), (F.col("id") % 3 - 1).alias("d"))
    got = windows.ordered_sums(df, ["k"], ["t", "seq"], {"s": "d"}, ranges)
    rows_, total = sorted((r["seq"], r["d"], r["s"]) for r in got.collect()), 0
    for _, d, s in rows_:
        total += d
        assert s == total
    dealt = df.repartitionByRange(ranges, "k", "t", "seq").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == ranges and max(r["count"] for r in dealt) <= 2 * n / ranges


def test_ordered_sums_over_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, None), ("a", 1, 7), ("b", 1, 1), ("b", 2, 2), (None, 3, 1)],
                               "k string, o long, d long")
    for ranges in (1, 3):
        got = {(r["k"], r["o"]): r["s"] for r in windows.ordered_sums(df, ["k"], ["o"], {"s": "d"}, ranges).collect()}
        assert got == {(None, 1): 5, (None, 2): 5, (None, 3): 6, ("a", 1): 7, ("b", 1): 1, ("b", 2): 3}
