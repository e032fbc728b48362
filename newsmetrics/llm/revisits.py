"""Operator 2, WARC not-modified revisits: as-of join to the latest earlier full response.

A revisit record says that a resource had not changed; its content is that of the
latest earlier full response with the same canonical URL. Records are range
partitioned by (URL, time), so a URL with very many records is spread over
partitions; within each (partition, URL) a window finds the latest response, and
a table with one row per (partition, URL) carries the last response over from
earlier partitions. Validators are checked (entity tags by weak comparison, else
the modification date, else the payload digest), and of the revisit's headers
those that RFC 9110, 15.4.5, lets a 304 update replace the response's.

Defined results: a revisit without earlier response is 'no_response', one whose
validators differ 'mismatch', one without comparable validators 'unverified', else
'resolved'; only 'resolved' and 'unverified' ones get merged headers, the others
null. A response at the same time as a revisit is not earlier; of responses at one
time the one with the largest record id counts. Records without URL or time match
nothing. Repeated records get a row each; header names are compared in lower
case, and a name that repeats keeps all its values; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmetrics.llm.common import table
from newsmetrics.session import materialize

#: Headers that a 304 response may update (RFC 9110, 15.4.5), fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that only track a visit.
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"
FIELDS = ("record_id", "etag", "last_modified", "digest", "headers")


def canonical_url(url: Column) -> Column:
    """host/path?query: scheme, user, www prefix, default port, fragment, tracking
    parameters, index page and last slash dropped, host in lower case, parameters sorted."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)?$", ""), r"^www[0-9]*\.", "")
    rest = F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"(/index\.html?)?/*$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(query) > 0, F.concat(
        F.lit("?"), F.array_join(query, "&"))).otherwise("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the update's permitted ones in place of their own, sorted by name and value."""
    lower = F.transform(F.coalesce(stored, F.array().cast("array<struct<name:string,value:string>>")),
                        lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))
    fresh = F.filter(F.transform(F.coalesce(update, F.array().cast("array<struct<name:string,value:string>>")),
                                 lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value"))),
                     lambda h: h["name"].isin(*PERMITTED))
    kept = F.filter(lower, lambda h: ~F.exists(fresh, lambda f: f["name"] == h["name"]))
    return F.array_sort(F.concat(kept, fresh))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records``.

    ``records``: record_id long, kind ('response' or 'revisit'), url, ts, etag,
    last_modified, digest, headers array<struct<name, value>>.
    """
    stored = F.struct(*(F.col(c).alias(c) for c in FIELDS))
    rows = records.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical"), "ts",
                          *FIELDS[1:], (F.col("kind") == "response").cast("int").alias("full"))
    rows = rows.where(F.col("canonical").isNotNull() & F.col("ts").isNotNull())
    lost = records.where((F.col("kind") == "revisit") & (canonical_url(F.col("url")).isNull() | F.col("ts").isNull()))
    dealt = materialize(rows.repartitionByRange("canonical", "ts", "full", "record_id")
                        .withColumn("block", F.spark_partition_id()), "warc-blocks")

    inside = (Window.partitionBy("block", "canonical").orderBy("ts", "full", "record_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    near = dealt.withColumn("near", F.last(F.when(F.col("full") == 1, stored), ignorenulls=True).over(inside))
    last = (dealt.groupBy("block", "canonical").agg(
        F.max_by(F.when(F.col("full") == 1, stored), F.when(F.col("full") == 1, F.struct("ts", "record_id"))).alias("own"))
        .select("block", "canonical", F.last("own", ignorenulls=True).over(
            Window.partitionBy("canonical").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("far")))
    found = (near.where("full = 0").join(last.where("far IS NOT NULL"), ["block", "canonical"], "left")
             .withColumn("hit", F.coalesce("near", "far")))
    hit = F.col("hit")
    agrees = (F.when(F.col("etag").isNotNull() & hit["etag"].isNotNull(), _weak(F.col("etag")) == _weak(hit["etag"]))
              .when(F.col("last_modified").isNotNull() & hit["last_modified"].isNotNull(),
                    F.col("last_modified") == hit["last_modified"])
              .when(F.col("digest").isNotNull() & hit["digest"].isNotNull(), F.col("digest") == hit["digest"]))
    status = (F.when(hit.isNull(), "no_response").when(agrees.isNull(), "unverified")
              .when(agrees, "resolved").otherwise("mismatch"))
    done = found.withColumn("status", status).select(
        "record_id", "canonical", "ts", "status", hit["record_id"].alias("response_id"),
        F.when(F.col("status").isin("resolved", "unverified"), hit["digest"]).alias("digest"),
        F.when(F.col("status").isin("resolved", "unverified"),
               merged_headers(hit["headers"], F.col("headers"))).alias("headers"))
    none = lost.select("record_id", canonical_url(F.col("url")).alias("canonical"), "ts",
                       F.lit("no_response").alias("status"), F.lit(None).cast("long").alias("response_id"),
                       F.lit(None).cast("string").alias("digest"),
                       F.lit(None).cast("array<struct<name:string,value:string>>").alias("headers"))
    return done.unionAll(none)


def _headers(*pairs: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs))


def captures(pages: DataFrame) -> DataFrame:
    """Records that follow from ``pages``: a response per page at ten times its id, and
    three revisits by other spellings of its URL, one before and two after it."""
    page, url, body = F.col("page_id"), F.col("url"), F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    case = F.length("url") % 4
    tag = F.concat(F.lit('"'), body, F.lit('"'))
    day = F.concat(F.lit("day "), page % 28)
    empty = F.lit(None).cast("string")
    other = F.concat(F.upper(F.substring_index(url, "/", 3)), F.substr(
        url, F.length(F.substring_index(url, "/", 3)) + 1), F.lit("#seen"))

    def record(number: int, kind: str, at: Column, where: Column, etag: Column, changed: Column, digest: Column,
               headers: Column) -> Column:
        return F.struct((page * 10 + number).alias("record_id"), F.lit(kind).alias("kind"), where.alias("url"),
                        at.alias("ts"), etag.alias("etag"), changed.alias("last_modified"), digest.alias("digest"),
                        headers.alias("headers"))

    return pages.select(F.explode(F.array(
        record(0, "response", page * 10, url, F.when(case != 3, tag), F.when(case < 3, day), body, _headers(
            ("Content-Type", F.lit("text/html")), ("ETag", tag), ("Date", (page * 10).cast("string")),
            ("Content-Length", F.length("html").cast("string")))),
        record(1, "revisit", page * 10 - 5, url, tag, day, body, _headers(("Date", F.lit("early")))),
        record(2, "revisit", page * 10 + 3, other, F.when(case == 0, F.concat(F.lit("W/"), tag))
               .when(case == 1, F.lit('"changed"')), F.when(case == 2, day), F.when(case != 3, body), _headers(
            ("Date", (page * 10 + 3).cast("string")), ("Expires", F.lit("soon")), ("Content-Length", F.lit("0")),
            ("content-type", F.lit("text/plain")))),
        record(3, "revisit", page * 10 + 20, url, tag, empty, empty, _headers(("cache-control", F.lit("no-store")))),
    )).alias("r")).select("r.*")


def op2_warc_revisits(spark, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"])), "; ")
    return found.select("record_id", "canonical", "ts", "status", "response_id", "digest", text.alias("headers"))


OP2_SQL = r"""
WITH pages_ AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS body, length(html) AS n,
         '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id % 28) AS day, url AS u FROM pages),
cased AS (SELECT *, length(url) % 4 AS kase, regexp_extract(url, '^([^/]*/[^/]*/[^/]*)', 1) AS head FROM pages_),
records AS (
  SELECT page_id * 10 AS record_id, 1 AS is_full, url, page_id * 10 AS ts,
         CASE WHEN kase <> 3 THEN tag END AS etag, CASE WHEN kase < 3 THEN day END AS modified, body AS digest,
         [{'name': 'content-type', 'value': 'text/html'}, {'name': 'etag', 'value': tag},
          {'name': 'date', 'value': CAST(page_id * 10 AS VARCHAR)},
          {'name': 'content-length', 'value': CAST(n AS VARCHAR)}] AS headers FROM cased
  UNION ALL
  SELECT page_id * 10 + 1, 0, url, page_id * 10 - 5, tag, day, body, [{'name': 'date', 'value': 'early'}] FROM cased
  UNION ALL
  SELECT page_id * 10 + 2, 0, upper(head) || substr(url, length(head) + 1) || '#seen', page_id * 10 + 3,
         CASE kase WHEN 0 THEN 'W/' || tag WHEN 1 THEN '"changed"' END, CASE WHEN kase = 2 THEN day END,
         CASE WHEN kase <> 3 THEN body END,
         [{'name': 'date', 'value': CAST(page_id * 10 + 3 AS VARCHAR)}, {'name': 'expires', 'value': 'soon'}] FROM cased
  UNION ALL
  SELECT page_id * 10 + 3, 0, url, page_id * 10 + 20, tag, NULL, NULL,
         [{'name': 'cache-control', 'value': 'no-store'}] FROM cased),
parts AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS p FROM records),
split AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)', 1)),
           ':(80|443)?$', ''), '^www[0-9]*\.', '') AS host,
         regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$', 1) AS rest FROM parts),
named AS (
  SELECT *, host || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '(/index\.html?)?/*$', '')
    || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref)(=|$)'))) AS query FROM split)),
found AS (
  SELECT v.*, r.record_id AS response_id, r.etag AS etag_, r.modified AS modified_, r.digest AS digest_, r.headers AS headers_
  FROM named v LEFT JOIN named r ON r.is_full = 1 AND r.canonical = v.canonical AND r.ts < v.ts
  WHERE v.is_full = 0
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL AND etag_ IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(etag_, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND modified_ IS NOT NULL THEN CASE WHEN modified = modified_ THEN 'resolved' ELSE 'mismatch' END
    WHEN digest IS NOT NULL AND digest_ IS NOT NULL THEN CASE WHEN digest = digest_ THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS status FROM found)
SELECT record_id, canonical, ts, status, response_id,
       CASE WHEN status IN ('resolved', 'unverified') THEN digest_ END AS digest,
       CASE WHEN status IN ('resolved', 'unverified') THEN array_to_string(list_sort(list_transform(
         list_concat(list_filter(headers_, lambda h: NOT list_contains(list_transform(headers, lambda f: f.name), h.name)), headers),
         lambda h: h.name || '=' || h.value)), '; ') END AS headers
FROM judged
"""
