"""Readers/writers and metric semantics on literal edge rows (FIXTURES B) and
the stored-snapshot invariants."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from newsmetrics import schemas
from newsmetrics.operators import metrics as M
from newsmetrics.operators import progress as P
from newsmetrics.operators import scrape_log as L
from newsmetrics.sources import io

COLS = ("arrival_seq long, url string, medio string, starting_time string, status string, "
        "fecha_publicacion string, finishing_time string, duration_ms string, error string, "
        "id_logging_process long")


def _log(spark, rows):
    full = [r + (None,) * (10 - len(r)) for r in rows]
    return L.typed(spark.createDataFrame(full, COLS))


def test_dedup_oldest_vs_latest(spark):
    rows = [(1, "u1", "m", "2025-01-01 00:00:00", "error", "", "2025-01-01 00:00:10", "10"),
            (2, "u1", "m", "2025-01-01 00:00:20", "success", "", "2025-01-01 00:00:30", "10"),
            (3, "u2", "m", "2025-01-01 00:00:40", "success", "", "2025-01-01 00:00:50", "10"),
            (4, "u2", "m", "2025-01-01 00:01:00", "error", "", "2025-01-01 00:01:10", "10"),
            (5, "", "m", "", "success", "", "", "123.45"),
            (6, None, "m", "", "success", "", "", "0.0")]
    t = _log(spark, rows)
    old = M.outlet_metrics(t, "oldest").first()
    new = M.outlet_metrics(t, "latest").first()
    assert (old.total_urls_procesadas, old.scrape_exitosos) == (2, 1)
    assert (new.total_urls_procesadas, new.scrape_exitosos) == (2, 1)
    st_old = {r.url: r.status for r in M.url_status(t, "oldest").collect()}
    st_new = {r.url: r.status for r in M.url_status(t, "latest").collect()}
    assert st_old["u1"] == "error" and st_new["u1"] == "success"
    assert st_old["u2"] == "success" and st_new["u2"] == "error"
    # wall time over all logs: 00:00:00 .. 00:01:10
    assert old.duracion_segundos == 70.0
    # mean time counts every duration (errors, duplicates, url-less rows)
    assert old.tiempo_promedio_scrape == pytest.approx((40 + 123.45 + 0.0) / 1000.0 / 1)


def test_times_and_durations_fallbacks(spark):
    # only durations, no times -> wall time = sum(durations)/1000
    t = _log(spark, [(1, "a", "m", "", "success", "", "", "1500"),
                     (2, "b", "m", "2025-1-5 3:4:5", "success", "", "", "abc"),
                     (3, "c", "m", "nope", "error", "", "", "")])
    r = M.outlet_metrics(t).first()
    assert r.duracion_segundos == 1.5
    assert r.noticias_por_minuto == pytest.approx(2 / (1.5 / 60))
    # no times and no durations -> 0
    t2 = _log(spark, [(1, "a", "m", "", "success", "", "", "")])
    r2 = M.outlet_metrics(t2).first()
    assert (r2.duracion_segundos, r2.noticias_por_minuto, r2.tiempo_promedio_scrape) == (0.0, 0.0, 0.0)


def test_medio_absent_vs_empty(spark):
    t = _log(spark, [(1, "a", None, "", "success"), (2, "b", "", "", "success")])
    assert sorted(r.medio for r in M.outlet_metrics(t).collect()) == ["", "unknown"]


def test_histogram_keys_and_order(spark):
    rows = [(i, f"u{i}", "m", "", "success", f) for i, f in enumerate(
        ["Lunes 10 mayo de 2025 | 10:30", "Lunes 10 mayo de 2025", "2025-05-19", "19/05/2025",
         "2025-05-19T21:22:48.24Z", "   ", "Jueves 18 Diciembre, 2025"])]
    t = _log(spark, rows)
    h = {r.fecha: r.n for r in M.publications_by_date(t).collect()}
    assert h == {"Lunes 10 mayo de 2025": 2, "Lunes 19 mayo de 2025": 3,
                 "Jueves 18 Diciembre, 2025": 1}
    m = M.histogram_map(M.publications_by_date(t)).first().publicaciones_por_fecha
    assert list(m.keys()) == sorted(h.keys())


def _progress(spark, rows):
    return spark.createDataFrame(rows, schemas.SCRAPE_PROGRESS)


def test_correction_above_equal_below_and_stale_outlet(spark):
    metrics = spark.createDataFrame(
        [("a", 10, 8, 2, 80.0, 100.0, 4.8, 0.5), ("b", 10, 8, 2, 80.0, 100.0, 4.8, 0.5),
         ("c", 10, 8, 2, 80.0, 100.0, 4.8, 0.5), ("d", 10, 8, 2, 80.0, 100.0, 4.8, 0.5),
         ("old", 1, 1, 0, 100.0, 1.0, 60.0, 1.0)],
        "medio string, total_urls_procesadas long, scrape_exitosos long, scrape_fallidos long, "
        "porcentaje_exito double, duracion_segundos double, noticias_por_minuto double, "
        "tiempo_promedio_scrape double")
    prog = _progress(spark, [
        ("a", 12, 3, 250.0, 0.0, "2025-01-01 00:02:00", "2025-01-01 00:00:00"),   # above
        ("b", 7, 3, 250.0, 0.0, "2025-01-01 00:02:00", "2025-01-01 00:00:00"),    # equal
        ("c", 5, 1, 250.0, 0.0, "2025-01-01 00:02:00", "2025-01-01 00:00:00"),    # below
        ("d", 12, 3, 250.0, 0.0, "", "2025-01-01 00:00:00"),                       # empty update
        ("old", 5, 0, 1000.0, 0.0, "2025-01-01 00:00:30", "2025-01-01 00:00:00")])  # stale outlet
    out = {r.medio: r for r in M.apply_progress(metrics, prog).collect()}
    a = out["a"]
    assert (a.total_urls_procesadas, a.scrape_exitosos, a.scrape_fallidos) == (15, 12, 3)
    assert a.duracion_segundos == 120.0 and a.noticias_por_minuto == 15 / 2.0
    assert a.tiempo_promedio_scrape == 0.25 and a.porcentaje_exito == pytest.approx(80.0)
    assert out["b"].total_urls_procesadas == 10 and out["c"].total_urls_procesadas == 10
    assert out["d"].total_urls_procesadas == 10
    assert out["old"].total_urls_procesadas == 5 and out["old"].noticias_por_minuto == 10.0


def test_snapshot_invariants(spark):
    """Golden figures of the stored snapshots (fixed values): 303 articles in 61 s,
    438 in 80 s, 1165 links over 78 categories in 400.88 s, 14 of 78 categories."""
    rate_a = 303 / (61 / 60)
    rate_b = 438 / (80 / 60)
    assert round(rate_a, 3) == 298.033 and round(rate_b, 3) == 328.5
    df = spark.createDataFrame([(14, 78, 1165, 400.88)], "done long, total long, urls long, dur double")
    r = df.select(F.round(P.crawl_progress_pct(F.col("done"), F.col("total")), 1).alias("p"),
                  F.round(F.col("urls") / F.col("total"), 3).alias("upc"),
                  F.round(F.col("urls") / (F.col("dur") / 60.0), 2).alias("upm")).first()
    assert (r.p, r.upc, r.upm) == (17.9, 14.936, 174.37)


def test_snapshot_reader_both_shapes_and_export(spark):
    tmp = tempfile.mkdtemp(prefix="nm-snap-")
    p1, p2, p3 = (os.path.join(tmp, n) for n in ("map.json", "single.json", "blank.json"))
    with open(p1, "w") as f:
        f.write('{"biobiochile": {"total_categorias": 78, "total_urls_encontradas": 1165, '
                '"urls_por_categoria": 14.936, "duracion_segundos": 400.88, '
                '"urls_por_minuto": 174.37}, "latercera": {"total_categorias": 27, '
                '"total_urls_encontradas": 438, "urls_por_categoria": 16.222, '
                '"duracion_segundos": 82.94, "urls_por_minuto": 316.84}}')
    with open(p2, "w") as f:
        f.write('{"sitio": "latercera", "total_categorias": 27, "total_urls_encontradas": 1518, '
                '"urls_por_categoria": 56.222, "duracion_segundos": 73.24, "urls_por_minuto": 1243.6}')
    with open(p3, "w") as f:
        f.write("   ")
    v = schemas.CRAWL_METRICS_VALUE
    m = {r.medio: r for r in io.read_snapshot(spark, p1, v, inline_key="sitio").collect()}
    assert m["biobiochile"].total_urls_encontradas == 1165 and len(m) == 2
    s = io.read_snapshot(spark, p2, v, inline_key="sitio").collect()
    assert [(r.medio, r.total_urls_encontradas) for r in s] == [("latercera", 1518)]
    assert io.read_snapshot(spark, p3, v).count() == 0
    out = os.path.join(tmp, "export")
    io.export_snapshot(io.read_snapshot(spark, p1, v), out)
    back = io.read_snapshot(spark, out, v)
    assert sorted(r.medio for r in back.collect()) == ["biobiochile", "latercera"]


def test_log_reader_quarantine(spark):
    tmp = tempfile.mkdtemp(prefix="nm-log-")
    p = os.path.join(tmp, "log.json")
    with open(p, "w") as f:
        f.write('{"arrival_seq": 1, "url": "a", "medio": "m", "status": "success"}\n'
                "\n{bad\n"
                '{"arrival_seq": "x", "url": "b"}\n')
    good, bad = io.read_log(spark, p, schemas.SCRAPE_LOG_RAW)
    assert [r.url for r in good.collect()] == ["a"]
    assert sorted(r.raw for r in bad.collect()) == ['{"arrival_seq": "x", "url": "b"}', "{bad"]


def test_crawl_csv_rows_range_and_first_failure(spark):
    tmp = tempfile.mkdtemp(prefix="nm-csv-")
    p = os.path.join(tmp, "crawl.csv")
    with open(p, "w") as f:
        f.write("nacional,https://x/1\n\ndeportes,https://x/2\nmundo,https://x/3\n"
                "nacional,https://x/4\n")
    df = io.read_crawl_csv(spark, p)
    assert [(r.idx, r.url) for r in df.orderBy("idx").collect()] == [
        (1, "https://x/1"), (2, "https://x/2"), (3, "https://x/3"), (4, "https://x/4")]
    assert [r.idx for r in io.row_range(df, 2, 3).collect()] == [2, 3]
    st = df.withColumn("status", F.when(F.col("idx") == 3, "error").otherwise("success"))
    assert sorted(r.idx for r in io.until_first_failure(st).collect()) == [1, 2]
    out = os.path.join(tmp, "out")
    io.write_crawl_csv(df, out)
    assert io.read_crawl_csv(spark, out).count() == 4


def test_crawl_csv_rows_of_several_files(spark):
    """Splits are dealt by size; the rows still count in the order of file names."""
    tmp = tempfile.mkdtemp(prefix="nm-csvs-")
    rows = [(f, k) for f, n in enumerate((3, 400, 36)) for k in range(n)]
    for f in range(3):
        with open(os.path.join(tmp, f"part-{f}.csv"), "w") as out:
            out.writelines(f"c{f},https://x/{f}/{k}\n" for g, k in rows if g == f)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = io.read_crawl_csv(spark, tmp).orderBy("idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.idx, r.url) for r in got] == [(i + 1, f"https://x/{f}/{k}") for i, (f, k) in enumerate(rows)]


def test_error_writer_replaces_a_replayed_epoch(spark):
    out = tempfile.mkdtemp(prefix="nm-err-")
    rows = spark.createDataFrame([("crawler", "x", "accepted"), ("other", "y", "rejected")],
                                 "`from` string, error_detail string, accepted string")
    for epoch in (0, 1, 1):
        io.write_errors(rows, out, epoch)
    assert spark.read.parquet(out + "/errors").count() == 2
    assert spark.read.parquet(out + "/quarantine").count() == 2


def test_upsert_and_reset(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "medio string, v long")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "medio string, v long")
    assert sorted(map(tuple, M.upsert_by_medio(old, new).collect())) == [("a", 1), ("b", 20), ("c", 30)]
    prog = spark.createDataFrame([("a", 5, 1, 10.0, 2.0, "x", "y")], schemas.SCRAPE_PROGRESS)
    r = {x.medio: x for x in M.reset_progress(prog, "a", "2025-01-01 00:00:00").collect()}
    assert r["a"].total_articulos_exitosos == 0 and r["a"].start_time == "2025-01-01 00:00:00"


def test_build_log_record(spark):
    df = spark.createDataFrame(
        [(1, "u", "m", "2025-01-01 00:00:00", "2025-01-01 00:00:01.5", "success", None, "F")],
        "seq long, url string, medio string, s string, f string, status string, error string, "
        "fecha_publicacion string").select(
        "seq", "url", "medio", F.to_timestamp("s").cast("timestamp_ntz").alias("start_ts"),
        F.to_timestamp("f").cast("timestamp_ntz").alias("finish_ts"), "status", "error",
        "fecha_publicacion")
    r = L.build_log(df, seq="seq").first()
    assert (r.starting_time, r.finishing_time, r.duration_ms, r.error) == (
        "2025-01-01 00:00:00", "2025-01-01 00:00:01", "1500.0", "")
