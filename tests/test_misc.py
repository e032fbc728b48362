"""Smaller operators: config check, JSON helpers, document export, ST4 stream form."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from newsmetrics import config
from newsmetrics.functions import jsonfn
from newsmetrics.operators import control as C
from newsmetrics.operators import document as DOC
from newsmetrics.operators import links as K
from newsmetrics.plans import derived as D
from newsmetrics.streaming import streams as S
from tests.conftest import SF_SMALL


def test_site_config_check(spark):
    links = spark.createDataFrame([("biobiochile", "u1"), ("latercera", "u2"), ("otro", "u3")],
                                  "medio string, url string")
    r = {x.medio: x for x in K.with_site_config(links, config.sites_df(spark)).collect()}
    assert r["biobiochile"].profile == "A" and r["latercera"].news_pattern == ["/noticia/"]
    assert r["otro"].profile is None and r["otro"].config_error is not None


def test_json_helpers(spark):
    df = spark.createDataFrame([('["nacional", "chile"]', "x"), ("nacional", "y"), ("[bad", "z")],
                               "tags string, k string")
    got = [r.t for r in df.select(jsonfn.tags_array("tags").alias("t")).collect()]
    assert got[0] == ["nacional", "chile"] and got[1] == ["nacional"]
    enc = df.select(jsonfn.encode("k", F.lit(None).cast("string").alias("n"), F.lit("ñ").alias("e"))
                    .alias("j")).first().j
    assert json.loads(enc) == {"k": "x", "e": "ñ"}
    m = spark.createDataFrame([({"a": 1},)], "m map<string,bigint>")
    r = m.select(jsonfn.get_or("m", "a", 0).alias("a"), jsonfn.get_or("m", "b", 0).alias("b")).first()
    assert (r.a, r.b) == (1, 0)
    arr = spark.createDataFrame([("[1, 2]",), ("",), ('{"url": "u"}',)], "v string")
    from newsmetrics import schemas
    dec = [r.d for r in arr.select(jsonfn.decode("v", schemas.URL_TASK).alias("d")).collect()]
    assert dec[1] is None and dec[2].url == "u"
    assert dec[0] is None or dec[0][jsonfn.CORRUPT] is not None or dec[0].url is None


def test_document_export_and_active_outlet(spark):
    m = spark.createDataFrame([("a", 1.0)], "medio string, x double")
    p = spark.createDataFrame([("a", 2), ("b", 3)], "medio string, y long")
    c = spark.createDataFrame([("c", 4)], "medio string, z long")
    doc = DOC.metrics_document(m, p, c)
    js = {r.medio: json.loads(r.document) for r in DOC.document_json(doc).collect()}
    assert js["a"] == {"scraper_metrics": {"x": 1.0}, "scraper_progress": {"y": 2}}
    assert js["c"] == {"crawler_metrics": {"z": 4}}
    crawl = spark.createDataFrame([("latercera",)], "sitio string")
    outlets = spark.createDataFrame([("biobiochile",), ("latercera",)], "medio string")
    assert DOC.active_outlet(crawl, outlets).first().medio_activo == "latercera"
    assert DOC.active_outlet(crawl.limit(0), outlets).first().medio_activo == "biobiochile"
    names = spark.createDataFrame([("biobiochile",), ("x",)], "m string")
    assert [r.n for r in names.select(DOC.display_name("m").alias("n")).collect()] == \
        ["BioBio Chile", "x"]


def test_lifecycle_stream_equals_batch(spark):
    tmp = tempfile.mkdtemp(prefix="nm-life-")
    ctrl = D.control_log(spark, SF_SMALL)
    ctrl.write.json(os.path.join(tmp, "c"))
    src = spark.readStream.schema(ctrl.schema).option("maxFilesPerTrigger", 1) \
        .json(os.path.join(tmp, "c"))
    name = "life_" + os.path.basename(tmp).replace("-", "_")
    q = (S.batch_lifecycle_stream(src).writeStream.outputMode("complete").format("memory")
         .queryName(name).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql(f"SELECT * FROM {name}")
    want = C.batch_lifecycle(ctrl)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_control_whitelist_and_error_origins(spark):
    df = spark.createDataFrame([(1, "start_batch", "2025-01-01 00:00:00"),
                                (1, "unknown", "2025-01-01 00:00:01")],
                               "id long, action string, t string") \
        .withColumn("t", F.to_timestamp("t"))
    assert [r.action for r in C.control_record(df, "id", "action", "t").collect()] == ["start_batch"]
    e = spark.createDataFrame([("crawler", None, "boom", None, None, 1),
                               ("robot", None, "x", "m", "s", 1)],
                              "origen string, error_ts timestamp, error_detail string, "
                              "arg_medio string, etapa string, id_logging_process long")
    r = C.error_record(e).collect()
    assert (r[0].arg_medio, r[0].stage, r[0].accepted) == ("", "", "accepted")
    assert r[1].accepted == "rejected"


def test_polls_over_a_long_silence(spark):
    """A log in year 1 and one in year 9999: the polls between cost no rows."""
    from newsmetrics.operators import progress as P
    rows = [("m", 1, "0001-01-01 00:00:00", "0001-01-01 00:00:30", "success"),
            ("m", 2, "9999-12-31 23:50:00", "9999-12-31 23:59:00", "error")]
    logs = spark.createDataFrame(rows, "medio string, arrival_seq long, s string, f string, status string").select(
        "medio", "arrival_seq", F.col("s").cast("timestamp_ntz").alias("start_ts"),
        F.col("f").cast("timestamp_ntz").alias("finish_ts"), "status")
    points = [tuple(r) for r in P.dashboard_series(logs).orderBy("t").collect()]
    assert points == [("m", "0001-01-01 00:00:00", 1, 0), ("m", "9999-12-31 23:50:00", 1, 1)]
    runs = [(r["first"], r["last"], r.backlog) for r in P.backlog_stalls(logs).orderBy("island").collect()]
    assert runs == [("0001-01-01 00:01:00", "9999-12-31 23:49:00", 0)]
