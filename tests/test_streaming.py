"""Structured Streaming forms agree with the batch operators (ST1, ST2, ST5-ST7, ST11)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from newsmetrics.operators import control as C
from newsmetrics.operators import progress as P
from newsmetrics.operators import scrape_log as L
from newsmetrics.plans import derived as D
from newsmetrics.streaming import streams as S
from tests.conftest import SF_SMALL


def _messages_dir(spark, tmp):
    logs = D.scrape_log(spark, SF_SMALL)
    msg = logs.select(F.lit("scraping_logs").alias("channel"), "arrival_seq",
                      F.to_json(F.struct(*[c for c in logs.columns if c != "arrival_seq"]))
                      .alias("value"))
    ctrl = D.control_log(spark, SF_SMALL).select(
        F.lit("control").alias("channel"), F.lit(None).cast("long").alias("arrival_seq"),
        F.to_json(F.struct("*")).alias("value"))
    msg.unionByName(ctrl).write.json(os.path.join(tmp, "in", "part1"))
    bad = [{"channel": "scraping_logs", "arrival_seq": -1, "value": ""},
           {"channel": "scraping_logs", "arrival_seq": -2, "value": "{bad"},
           {"channel": "control", "arrival_seq": -3, "value": '{"id_logging_process": "x"}'},
           {"channel": "nowhere", "arrival_seq": -4, "value": "{}"}]
    os.makedirs(os.path.join(tmp, "in", "part2"))
    with open(os.path.join(tmp, "in", "part2", "bad.json"), "w") as f:
        f.write("\n".join(json.dumps(b) for b in bad) + "\n")
    return logs


def test_router_matches_batch_and_quarantines(spark):
    tmp = tempfile.mkdtemp(prefix="nm-router-")
    logs = _messages_dir(spark, tmp)
    q = S.start_router(S.read_messages(spark, os.path.join(tmp, "in", "*")),
                       os.path.join(tmp, "out"), name=f"router-{os.path.basename(tmp)}")
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(tmp, "out", "scraping_results")).drop("epoch")
    assert got.count() == logs.count()
    assert got.select(sorted(logs.columns)).exceptAll(logs.select(sorted(logs.columns))).count() == 0
    quarantine = spark.read.parquet(os.path.join(tmp, "out", "quarantine"))
    assert sorted(r.arrival_seq for r in quarantine.collect()) == [-4, -3, -2, -1]
    ctrl = spark.read.parquet(os.path.join(tmp, "out", "control"))
    assert ctrl.count() == D.control_log(spark, SF_SMALL).count()


def test_live_progress_stream_equals_batch(spark):
    tmp = tempfile.mkdtemp(prefix="nm-prog-")
    logs = D.scrape_log(spark, SF_SMALL)
    logs.write.json(os.path.join(tmp, "logs"))
    from newsmetrics import schemas
    stream = spark.readStream.schema(schemas.SCRAPE_LOG_RAW).option("maxFilesPerTrigger", 2) \
        .json(os.path.join(tmp, "logs"))
    q = S.start_live_progress(stream, os.path.join(tmp, "store"),
                              name=f"prog-{os.path.basename(tmp)}")
    q.awaitTermination(300)
    got = S.latest_version(spark, os.path.join(tmp, "store"))
    want = P.live_progress(L.typed(logs))
    g = {r.medio: r for r in got.collect()}
    for w in want.collect():
        r = g[w.medio]
        assert r.total_articulos_exitosos == w.total_articulos_exitosos
        assert r.total_articulos_fallidos == w.total_articulos_fallidos
        assert abs(r.duracion_promedio_ms - w.duracion_promedio_ms) < 1e-6


def test_idle_sessions_stream_equals_batch(spark):
    tmp = tempfile.mkdtemp(prefix="nm-sess-")
    ev = D.table(spark, SF_SMALL, "events").select("event_id", "ts", F.lit("L1").alias("logger"))
    ev.write.parquet(os.path.join(tmp, "ev"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(tmp, "ev"))
    q = (S.idle_batches_stream(stream).writeStream.outputMode("append").format("memory")
         .queryName("sess_" + os.path.basename(tmp).replace("-", "_"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql(f"SELECT * FROM sess_{os.path.basename(tmp).replace('-', '_')}")
    batch = C.idle_sessions(ev)
    # the stream only emits sessions closed by the watermark; all but the last
    n_stream = got.count()
    assert n_stream >= batch.count() - 1
    s_counts = sorted(r.n_events for r in got.collect())
    b_counts = sorted(r.n_events for r in batch.collect())
    assert all(c in b_counts for c in s_counts)


def test_dedup_tasks_stream(spark):
    tmp = tempfile.mkdtemp(prefix="nm-dedup-")
    rows = [("https://a/1", "t", "m", "2025-01-01 00:00:00"),
            ("https://a/1", "t", "m", "2025-01-01 00:00:05"),
            ("https://a/2", "t", "m", "2025-01-01 00:00:06"), ("https://a/0", "t", "m", "2025-01-01 00:00:07"),
            ("https://a/1", "t", "m", "2025-01-09 00:00:00")]
    spark.createDataFrame(rows, "url string, tags string, medio string, sent_at string") \
        .withColumn("sent_at", F.to_timestamp("sent_at")).write.parquet(os.path.join(tmp, "t"))
    src = spark.readStream.schema("url string, tags string, medio string, sent_at timestamp") \
        .parquet(os.path.join(tmp, "t"))
    name = "dedup_" + os.path.basename(tmp).replace("-", "_")
    q = (S.dedup_tasks(src, spark.createDataFrame([("https://a/0",)], "url string")).writeStream.format("memory").queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(r.url for r in spark.sql(f"SELECT url FROM {name}").collect()) == \
        ["https://a/1", "https://a/2"]


def test_outcomes_become_articles_and_logs(spark):
    from newsmetrics.operators import extract as X
    out = tempfile.mkdtemp(prefix="nm-out-")
    pages = spark.createDataFrame(
        [(1, "https://x/1", "m", "G", "<article><h1>T</h1><p>text</p></article>"), (2, "https://x/2", "m", "G", "<p>x</p>"),
         (3, "https://x/3", "m", "G", "<![foo bar]>")], "page_id long, url string, medio string, profile string, html string")
    batch = X.extract_articles(pages).select(
        "*", F.col("page_id").alias("arrival_seq"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("start_ts"),
        F.lit("2025-01-01 00:00:01.5").cast("timestamp_ntz").alias("finish_ts"))
    sink = S.scrape_outcome_sink(out, 7)
    for epoch in (0, 0):  # a replay
        sink(batch, epoch)
    assert [r.url for r in spark.read.parquet(out + "/articles").collect()] == ["https://x/1"]
    logs = {r.url: r for r in spark.read.parquet(out + "/scrape_results").collect()}
    assert len(logs) == 3 and {r.id_logging_process for r in logs.values()} == {7}
    assert logs["https://x/1"].duration_ms == "1500.0" and logs["https://x/1"].error == ""
    assert logs["https://x/2"].status == "error" and "AssertionError" in logs["https://x/3"].error
