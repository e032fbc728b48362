"""Versioned tables and the streams over them (K6-K8, ST6, ST8)."""
import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsmetrics import schemas
from newsmetrics.operators import scrape_log as L
from newsmetrics.plans import derived as D
from newsmetrics.sources.versioned import Conflict, VersionedTable, first_of_key, last_of_key
from newsmetrics.streaming import stores
from tests.conftest import SF_SMALL

UPSERT = last_of_key(["k"], "seq")


def new_table(spark, buckets=4, path=None):
    return VersionedTable(spark, path or tempfile.mkdtemp(prefix="nm-versioned-"), "k string, seq long, v string", ["k"], buckets)


def rows(spark, *items):
    return spark.createDataFrame(items, "k string, seq long, v string")


def content(t, version=None):
    return {r["k"]: r["v"] for r in t.read(version).collect()}


def test_upsert_rewrites_only_touched_buckets(spark):
    t = new_table(spark, buckets=8)
    assert content(t) == {} and t.version()["version"] == 0
    first = t.merge(rows(spark, *[(f"k{i}", 1, "a") for i in range(40)]), UPSERT)
    second = t.merge(rows(spark, ("k1", 2, "b"), ("new", 1, "n"), ("k2", 0, "older")), UPSERT)
    changed = {b for b, f in second["parts"].items() if first["parts"].get(b) != f}
    assert 1 <= len(changed) <= 3
    want = {f"k{i}": "a" for i in range(40)} | {"k1": "b", "new": "n"}
    assert content(t) == want and content(t, first) == {f"k{i}": "a" for i in range(40)}
    t.merge(rows(spark, ("k1", 2, "b"), ("new", 1, "n")), UPSERT)  # delivered again
    assert content(t) == want
    t.merge(rows(spark), UPSERT)
    assert content(t) == want


def test_two_writers_lose_nothing(spark):
    """The second writer commits while the first one is at work."""
    for same in (False, True):
        t = new_table(spark, buckets=1 if same else 8)
        other = new_table(spark, buckets=t.buckets, path=t.root)
        t.merge(rows(spark, ("a", 1, "a1"), ("b", 1, "b1")), UPSERT)
        tries = []

        def slow(old, new):
            made = UPSERT(old, new)
            if not tries:
                other.merge(rows(spark, ("b", 2, "b2")), UPSERT)
            tries.append(1)
            return made

        t.merge(rows(spark, ("a", 2, "a2")), slow)
        assert content(t) == {"a": "a2", "b": "b2"}
        assert len(tries) == (2 if same else 1)  # other buckets need no second merge


def test_a_writer_that_always_comes_second_gives_up(spark, monkeypatch):
    t = new_table(spark)
    monkeypatch.setattr(t, "_commit", lambda version: False)
    with pytest.raises(Conflict):
        t.merge(rows(spark, ("a", 1, "x")), UPSERT)
    assert content(t) == {}


def test_readers_keep_their_version_and_vacuum_keeps_the_last(spark):
    t = new_table(spark)
    for i in range(5):
        taken = t.version()
        t.merge(rows(spark, ("a", i, str(i)), (f"x{i}", 1, "x")), UPSERT)
        assert content(t, taken).get("a") == (str(i - 1) if i else None)
        t.vacuum(keep=2)
    assert content(t)["a"] == "4" and len(t.files.names(f"{t.root}/versions")) == 2
    assert content(t, t.version(4))["a"] == "3"
    os.makedirs(f"{t.root}/data/000000000009-underway")  # a change under way
    t.vacuum(keep=1)
    assert "000000000009-underway" in t.files.names(f"{t.root}/data")
    t.vacuum(keep=1, orphan_hours=-1)
    assert "000000000009-underway" not in t.files.names(f"{t.root}/data") and content(t)["a"] == "4"


def test_redelivered_logs_count_once(spark):
    """Events delivered twice, in one epoch and in a later one, and a replayed epoch."""
    tmp = tempfile.mkdtemp(prefix="nm-redelivery-")
    logs = D.scrape_log(spark, SF_SMALL).select([f.name for f in schemas.SCRAPE_LOG_RAW.fields])
    again = logs.where("arrival_seq % 5 = 0").withColumn("arrival_seq", F.col("arrival_seq") + 10 ** 6)
    for k in range(3):
        part = logs.where(f"arrival_seq % 3 = {k}")
        if k:
            part = part.unionByName(again.where(f"(arrival_seq - 1000000) % 3 = {k - 1}"))
        else:
            part = part.unionByName(again.where("arrival_seq % 7 = 0"))
        part.coalesce(1).write.json(os.path.join(tmp, "in", f"p{k}"))
    table = stores.log_table(spark, os.path.join(tmp, "table"), buckets=5)
    stream = spark.readStream.schema(schemas.SCRAPE_LOG_RAW).option("maxFilesPerTrigger", 1).json(os.path.join(tmp, "in", "*"))
    q = stores.start_log_merge(stream, table, os.path.basename(tmp))
    q.awaitTermination(300)
    assert len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) == 3
    got = table.read()
    want = logs.groupBy(*stores.LOG_KEY).agg(F.min("arrival_seq").alias("arrival_seq"))
    assert got.count() == want.count() < logs.count() + again.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    stores.merge_sink(table, first_of_key(stores.LOG_KEY, "arrival_seq"))(spark.read.schema(schemas.SCRAPE_LOG_RAW).json(os.path.join(tmp, "in", "p1")), 1)
    assert table.read().select(*want.columns).exceptAll(want).count() == 0 and table.read().count() == want.count()


def test_urls_are_sent_once_and_the_state_stays_flat(spark):
    tmp = tempfile.mkdtemp(prefix="nm-urls-")
    t0 = datetime(2025, 1, 1)
    schema = "url string, tags string, sent_at timestamp"
    batches, want = [], {}
    for k in range(6):  # three hours apart; each batch repeats old and recent URLs
        batch = [(f"https://a/{k}-{i}", "t", t0 + timedelta(hours=3 * k, seconds=i)) for i in range(50)]
        batch += [(f"https://a/{j}-{j}", "again", t0 + timedelta(hours=3 * k, minutes=5, seconds=j)) for j in range(k + 1)]
        for u, _, _ in batch:
            want.setdefault(u, k)
        batches.append(batch)
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(os.path.join(tmp, "in", f"b{k}"))
    memory = stores.UrlMemory(spark, os.path.join(tmp, "memory"), buckets=3, bits=1 << 10)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(tmp, "in", "*"))
    q = stores.start_sending(stream, memory, os.path.join(tmp, "out"), os.path.basename(tmp))
    q.awaitTermination(300)
    sent = spark.read.parquet(os.path.join(tmp, "out"))
    assert {r["url"]: r["epoch"] for r in sent.collect()} == want and sent.count() == len(want)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(kept) <= 120  # the URLs of two batches, not of all six
    memory.send(spark.createDataFrame(batches[5], schema), 5, os.path.join(tmp, "out"))  # a replay
    assert spark.read.parquet(os.path.join(tmp, "out")).count() == len(want)
    memory.send(spark.createDataFrame(batches[0] + [(None, "null", t0), ("https://b", "", t0)], schema), 60, os.path.join(tmp, "out"))
    assert [r["url"] for r in spark.read.parquet(os.path.join(tmp, "out")).where("epoch = 60").collect()] == ["https://b"]


def test_counters_restart_after_a_reset(spark):
    log = L.typed(D.scrape_log(spark, SF_SMALL))
    none = spark.createDataFrame([], "medio string, seq long")
    reset = spark.createDataFrame([("latercera", 500), ("otro", 1)], "medio string, seq long")
    table = stores.counter_table(spark, tempfile.mkdtemp(prefix="nm-counters-"))
    for epoch, (low, high) in enumerate([(0, 300), (300, 700), (700, 10 ** 9)]):
        batch = log.where(f"arrival_seq >= {low} AND arrival_seq < {high}")
        for _ in range(2 if epoch == 1 else 1):  # the second epoch is replayed
            stores.count_into(table, batch, reset if epoch == 1 else none, epoch)
    got = {r["medio"]: r for r in table.read().collect()}
    want = {r["medio"]: r for r in stores.counted(log, reset).collect()}
    assert got.keys() == want.keys() == {"biobiochile", "latercera", "otro"}
    for k, w in want.items():
        assert got[k][:3] == w[:3] and got[k][4:] == w[4:] and got[k]["dur_sum"] == pytest.approx(w["dur_sum"])
    after = log.where("medio = 'latercera' AND arrival_seq > 500")
    assert got["latercera"]["exitosos"] + got["latercera"]["fallidos"] == after.count()
    snap = {r["medio"]: r for r in stores.progress_snapshot(table.read()).collect()}
    assert snap["otro"]["ultima_actualizacion"] == "" and snap["otro"]["articulos_por_minuto"] == 0.0
    assert snap["latercera"]["articulos_por_minuto"] > 0


def test_feed_publishes_whole_snapshots(spark):
    """One file per second of the log: the versions are the one-second series, whatever a reader takes meanwhile."""
    from newsmetrics.operators import progress as P
    tmp = tempfile.mkdtemp(prefix="nm-feed-")
    fields = [f.name for f in schemas.SCRAPE_LOG_RAW.fields]
    logs = D.scrape_log(spark, SF_SMALL).where("arrival_seq < 40 AND starting_time <> ''").select(fields)
    seconds = sorted({r["starting_time"] for r in logs.collect()})
    for k, second in enumerate(seconds):
        logs.where(F.col("starting_time") == second).coalesce(1).write.json(os.path.join(tmp, "in", f"s{k:03d}"))
        for f in os.listdir(os.path.join(tmp, "in", f"s{k:03d}")):
            os.utime(os.path.join(tmp, "in", f"s{k:03d}", f), (10 ** 9 + k, 10 ** 9 + k))  # the order of reading
    table = stores.counter_table(spark, os.path.join(tmp, "table"))
    stream = spark.readStream.schema(schemas.SCRAPE_LOG_RAW).option("maxFilesPerTrigger", 1).json(os.path.join(tmp, "in", "*"))
    q = stores.start_feed(stream, table, os.path.basename(tmp), keep=1000, available_now=True)
    taken = []
    while q.isActive:
        v = table.version()
        taken.append((v["version"], sum(r["exitosos"] + r["fallidos"] for r in table.read(v).collect())))
    q.awaitTermination(300)
    assert all(n == v for v, n in taken) and len(taken) > 3  # one log a second here: version v holds v logs
    series = P.dashboard_series(L.typed(logs), step_s=1).orderBy("t").collect()
    assert table.version()["version"] == len(seconds) == len(series)
    for k, point in enumerate(series):
        seen = {r["medio"]: r for r in table.read(table.version(k + 1)).collect()}[point["medio"]]
        assert (seen["exitosos"], seen["fallidos"]) == (point["exitosos"], point["fallidos"])


def test_feed_restarts_at_a_marker(spark):
    tmp = tempfile.mkdtemp(prefix="nm-feed-")
    row = {f.name: None for f in schemas.SCRAPE_LOG_RAW.fields}
    rows_ = [{**row, "arrival_seq": i, "medio": "m", "url": f"u{i}", "status": s, "starting_time": "2025-01-01 00:00:00"}
             for i, s in enumerate(["success", "error", stores.RESET, "success"])]
    spark.createDataFrame(rows_, schemas.SCRAPE_LOG_RAW).coalesce(1).write.json(os.path.join(tmp, "in"))
    table = stores.counter_table(spark, os.path.join(tmp, "table"))
    stores.start_feed(spark.readStream.schema(schemas.SCRAPE_LOG_RAW).json(os.path.join(tmp, "in")), table,
                      os.path.basename(tmp), available_now=True).awaitTermination(300)
    assert [(r["exitosos"], r["fallidos"], r["reset_seq"]) for r in table.read().collect()] == [(1, 0, 2)]
