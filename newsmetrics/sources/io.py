"""Readers and writers.

Logs and snapshots are read with fixed schemas; undecodable input goes to a
quarantine DataFrame instead of failing or silently emptying the read (the
reference drops a whole list on one bad entry). Writes are idempotent per
micro-batch / run: a re-executed task or batch overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.jsonfn import CORRUPT, decode, decode_reason


# ------------------------------------------------------------------ readers

def read_snapshot(spark: SparkSession, path: str, value_schema: T.StructType,
                  key: str = "medio", inline_key: str | None = None) -> DataFrame:
    """A JSON snapshot ``{outlet: {...}}`` -> one row per outlet.

    The file is read whole (``wholetext``) and parsed as a map, not by schema
    inference (which would make one column per outlet / per date). A blank or
    corrupt file gives no rows. ``inline_key`` accepts the old single-site
    shape where the outlet is a field of one object (e.g. ``sitio``).
    """
    txt = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), T.MapType(T.StringType(), value_schema))
    rows = txt.select(F.explode(m).alias(key, "v")).select(key, "v.*")
    if inline_key is None:
        return rows
    single = T.StructType(list(value_schema.fields) + [T.StructField(inline_key, T.StringType())])
    one = txt.select(F.from_json("value", single).alias("v")).filter(
        F.col(f"v.{inline_key}").isNotNull()).select(F.col(f"v.{inline_key}").alias(key),
                                                     *[F.col(f"v.{f.name}") for f in value_schema])
    # a map-shaped file fails the single-object parse (no inline key) and vice
    # versa, so the two readings never overlap
    return rows.unionByName(one)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S2 / JS2 / ST2: JSON-lines log -> (good rows, quarantined raw lines).

    Blank lines are ignored; a line that is not a JSON object of the schema is
    kept in the quarantine output with its text.
    """
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parsed = lines.select(F.col("value").alias("raw"), decode("value", schema).alias("r"))
    good = parsed.filter(F.col(f"r.{CORRUPT}").isNull()).select("r.*").drop(CORRUPT)
    bad = parsed.filter(F.col(f"r.{CORRUPT}").isNotNull()).select("raw")
    return good, bad


def decoded_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """S2 / JS2 / ST2 in one pass: the record's fields, and for a bad line its text and the reason.

    ``lines`` has the column value (and others, kept). Good rows have null raw and reason; bad
    rows have null fields, also where a part of the line could be read.
    """
    d = lines.withColumn("__r", decode("value", schema)).withColumn("reason", decode_reason("value", "__r"))
    keep = [c for c in lines.columns if c != "value"]
    return d.select(*keep, *[F.when(F.col("reason").isNull(), F.col("__r")[f.name]).alias(f.name) for f in schema.fields],
                    F.when(F.col("reason").isNotNull(), F.col("value")).alias("raw"), "reason")


def read_crawl_csv(spark: SparkSession, path: str) -> DataFrame:
    """Crawl CSV (no header) with its 1-based row number in file order.

    Files count in the order of their names. Spark deals splits to tasks by
    size, so the order is taken from each row's file and split start; inside a
    split the ids that Spark gives out increase. Rows are numbered per split,
    and the splits' first numbers come from a table with one row per split.
    """
    rows = (spark.read.schema(schemas.CRAWL_CSV).option("header", "false").csv(path)
            .filter(F.col("categoria").isNotNull() | F.col("url").isNotNull())
            .select("categoria", "url", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("begin"),
                    F.monotonically_increasing_id().alias("at")))
    split = ["file", "begin"]
    counts = rows.groupBy(*split).agg(F.count("*").alias("rows"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*split, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy(*split).orderBy("at"))
    return (rows.withColumn("number", number).join(first, split)
            .select((F.col("first") + F.col("number")).cast("long").alias("idx"), "categoria", "url"))


def row_range(df: DataFrame, desde: int = 1, hasta: int | None = None) -> DataFrame:
    """Rows ``desde``..``hasta`` (1-based, inclusive; open end when None)."""
    cond = F.col("idx") >= desde
    if hasta is not None:
        cond = cond & (F.col("idx") <= hasta)
    return df.filter(cond)


def until_first_failure(df: DataFrame, status_col: str = "status") -> DataFrame:
    """rows before the first failing row (by ``idx``); all rows if none fails."""
    first_bad = df.filter(F.col(status_col) != "success").agg(F.min("idx")).scalar()
    return df.filter(first_bad.isNull() | (F.col("idx") < first_bad))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page table (url, html) is the document source; no fetching."""
    return spark.read.parquet(path).select("page_id", "url", "html")


# ------------------------------------------------------------------ writers

def write_crawl_csv(links: DataFrame, path: str) -> None:
    """K1: distinct (categoria, url), no header."""
    links.select("categoria", "url").distinct().write.mode("overwrite").csv(path, header=False)


def write_articles(articles: DataFrame, path: str) -> None:
    """K2 / K3: article records (``article_a``, ``article_b`` with ``outlet=True``) as UTF-8 JSON
    lines, one folder per outlet."""
    articles.write.mode("overwrite").partitionBy("medio").json(path)


def append_log(df: DataFrame, path: str, epoch: int | None = None) -> None:
    """Append a log batch; with ``epoch`` the write is idempotent.

    A replayed micro-batch (same epoch) overwrites its own partition instead of
    appending duplicates (dynamic partition overwrite).
    """
    if epoch is None:
        df.write.mode("append").parquet(path)
        return
    (df.withColumn("epoch", F.lit(int(epoch)).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("epoch").parquet(path))


def write_errors(errors: DataFrame, path: str, epoch: int | None = None) -> None:
    """Error records; rejected origins in quarantine. A replayed epoch replaces its own rows."""
    append_log(errors.filter(F.col("accepted") == "accepted").drop("accepted"), path + "/errors", epoch)
    append_log(errors.filter(F.col("accepted") != "accepted"), path + "/quarantine", epoch)


def export_snapshot(rows: DataFrame, path: str, key: str = "medio") -> None:
    """K6 / K7 / P9 export: one JSON object ``{outlet: {...}}`` (outlets sorted).

    The export gathers one row per outlet into one value; the input is already
    aggregated per outlet (a handful of rows), never raw data.
    """
    vals = [c for c in rows.columns if c != key]
    by_key = lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)  # noqa: E731  maps have no order
    obj = rows.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.col(key), F.struct(*vals).alias("v"))), by_key)).alias("m"))
    obj.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(path)
