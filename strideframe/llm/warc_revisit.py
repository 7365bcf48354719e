"""Resolution of not-modified revisits in web archive records.

A revisit (a 304 answer without a body) stands for the latest earlier full
response of the same canonical URL.  The as-of join finds that response, the
validators decide whether it is the one meant, and the stored headers are
brought up to date with those headers that a 304 may change.

The join is a sort, not a pairing: records are dealt to (URL, time range), the
last full response before each revisit is a running value there, and the one
that precedes a range comes from one row per URL and range.  Time ranges hold
about ``rows_per_range`` records of all URLs together, so a URL with a third
of all records is spread over a third of the ranges.  Bodies never move: a
digest stands for them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm.common import read_table

ROWS_PER_RANGE = 100_000

# Headers that a 304 answer may bring up to date, and query parameters that only track.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "^(utm_[^=]*|ref|gclid|fbclid)(=|$)"

_HOST = "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without "www." and a default port, path without a
    trailing slash, and the sorted query parameters that do not track; scheme
    and fragment do not count.  Text without a host only loses its fragment."""
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, _HOST, 1)), "^www\\.|:(80|443)$", "")
    rest = F.regexp_replace(bare, _HOST, "")
    path = F.regexp_replace(F.regexp_replace(rest, "\\?.*$", ""), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    full = F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(host == "", bare).otherwise(full)


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _time_ranges(records: DataFrame, rows_per_range: int) -> list:
    n = records.count()
    k = math.ceil(n / rows_per_range)
    if k < 2:
        return []
    q = records.agg(F.percentile_approx("ts", [i / k for i in range(1, k)], 100 * k)).first()[0]
    return sorted(set(q or []))


def resolve_revisits(records: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per revisit of ``records``: record_id, url_key, ts, base_id,
    outcome, headers, digest.

    ``records`` has record_id, url, ts (integer), kind ("response" or
    "revisit"), status, headers (map, names in lower case) and digest; other
    columns are not read.  The base is the response with status 200 of the same
    canonical URL with the largest ts below the revisit's (of equal ones the
    largest record_id).  outcome is

    * ``resolved``: the entity tags agree (weak comparison) or, without a tag
      on the revisit, the last-modified values do; headers are the base's with
      the permitted ones of the revisit over them, digest is the base's;
    * ``mismatch``: the base has another validator, or lacks the revisit's;
    * ``unverified``: the revisit has no validator but the base does;
    * ``resolved`` also if neither has one;
    * ``orphan``: no base; also for a null url or ts.

    Without resolution headers and digest are null.  Null headers count as
    empty.  Repeated rows each give a row; an empty table gives none.
    """
    r = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"),
                       "kind", "status", F.coalesce("headers", F.expr("cast(map() as map<string,string>)")).alias("own"),
                       "digest").filter("kind IN ('response', 'revisit')")
    bounds = _time_ranges(r.filter("ts IS NOT NULL"), rows_per_range)
    cut = F.lit(0)
    if bounds:
        cut = F.expr(f"size(filter(array({', '.join(f'{b}L' for b in bounds)}), b -> b <= ts))") \
            if len(bounds) < 64 else _bisect("ts", bounds, 0, len(bounds))
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("ts").isNotNull()
    base = F.when(full, F.struct("ts", "record_id", F.col("own").alias("headers"), "digest"))
    # a response that can't be a base goes; so revisits and bases remain
    r = r.withColumn("base", base).filter("kind = 'revisit' OR base IS NOT NULL").withColumn("range", cut)
    key = ["url_key", "range"]
    order = [F.col("ts"), F.when(F.col("kind") == "revisit", 0).otherwise(1), F.col("record_id")]
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = r.withColumn("near", F.last("base", ignorenulls=True).over(before)).filter("kind = 'revisit'")

    ends = r.filter("base IS NOT NULL").groupBy(*key).agg(F.max_by("base", F.struct("ts", "record_id")).alias("end"))
    every = (r.filter("kind = 'revisit'").select(*key).distinct().withColumn("end", F.lit(None).cast(
        ends.schema["end"].dataType)).unionByName(ends).groupBy(*key).agg(F.first("end", ignorenulls=True).alias("end")))
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(*key, F.last("end", ignorenulls=True).over(earlier).alias("carried")).filter(
        "carried IS NOT NULL")
    found = near.join(carried, key, "left").withColumn(
        "base", F.when(F.col("ts").isNotNull() & F.col("url_key").isNotNull(), F.coalesce("near", "carried")))

    tag, tag0 = _opaque(F.col("own")["etag"]), _opaque(F.col("base.headers")["etag"])
    mod, mod0 = F.col("own")["last-modified"], F.col("base.headers")["last-modified"]
    agree = F.when(tag.isNotNull(), F.coalesce(tag == tag0, F.lit(False))).when(
        mod.isNotNull(), F.coalesce(mod == mod0, F.lit(False)))
    outcome = (F.when(F.col("base").isNull(), "orphan").when(agree, "resolved").when(~agree, "mismatch")
                .when(tag0.isNull() & mod0.isNull(), "resolved").otherwise("unverified"))
    allowed = F.map_filter("own", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter("base.headers", lambda k, v: ~F.map_contains_key(allowed, k))
    good = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "record_id", "url_key", "ts", F.col("base.record_id").alias("base_id"), "outcome",
        F.when(good, F.map_concat(kept, allowed)).alias("headers"), F.when(good, F.col("base.digest")).alias("digest"))


def _bisect(column: str, bounds: list, lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(F.col(column) < bounds[mid], _bisect(column, bounds, lo, mid)).otherwise(
        _bisect(column, bounds, mid + 1, hi))


def records_from_pages(pages: DataFrame) -> DataFrame:
    """A crawl history made from pages: every page is fetched once, asked for
    again by its tag (1 to 3 days later, or 10 days later by its modification
    time) under variants of its URL, and every seventh also with a stale tag
    shortly before its fetch.  One in 13 fetches fails (status 404)."""
    p = pages.select("page_id", "url", "html")
    t0 = F.col("page_id") * 60
    tag = F.substring(F.md5("html"), 1, 16)
    modified = t0 - F.col("page_id") % 997
    bare = F.regexp_replace("url", "#.*$", "")
    marked = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_source=again"))

    def record(offset: int, ts, url, kind: str, status, headers: dict, digest) -> Column:
        entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in headers.items()])
        return F.struct(
            (F.col("page_id") * 4 + offset).alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"),
            status.alias("status"), F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("headers"),
            digest.alias("digest"))

    none, not_modified = F.lit(None).cast("string"), F.lit(304)
    day = 86_400
    first = record(0, t0, F.col("url"), "response", F.when(F.col("page_id") % 13 == 7, 404).otherwise(200), {
        "content-type": F.lit("text/html"), "content-length": F.octet_length("html"), "date": t0,
        "etag": F.concat(F.lit('"'), tag, F.lit('"')), "last-modified": modified,
        "cache-control": F.lit("max-age=60"), "server": F.lit("origin")}, F.sha2("html", 256))
    by_tag = t0 + day * (1 + F.col("page_id") % 3)
    again = record(1, by_tag, F.concat(bare, F.lit("#again")), "revisit", not_modified, {
        "date": by_tag, "etag": F.concat(F.lit('W/"'), tag, F.lit('"')), "cache-control": F.lit("max-age=120"),
        "expires": by_tag + 120, "server": F.lit("edge")}, none)
    by_time = t0 + day * 10
    later = record(2, by_time, marked, "revisit", not_modified, {
        "date": by_time, "last-modified": F.when(F.col("page_id") % 5 != 0, modified).otherwise(t0 + 1),
        "content-length": F.lit("0")}, none)
    stale = record(3, t0 - 30, F.col("url"), "revisit", not_modified, {"date": t0 - 30, "etag": F.lit('"0"')}, none)
    every = F.when(F.col("page_id") % 7 == 0, F.array(first, again, later, stale)).otherwise(F.array(first, again, later))
    return p.select(F.explode(every).alias("x")).select("x.*")


def op10_warc_revisit(spark, sf_dir: str) -> DataFrame:
    """Query: ``resolve_revisits`` over the crawl history of all pages; the
    merged headers as "name: value" lines in the order of their names."""
    out = resolve_revisits(records_from_pages(read_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.withColumn("headers", F.array_join(lines, "\n"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, page_id * 60 AS t0, substr(md5(html), 1, 16) AS tag, page_id * 60 - page_id % 997 AS modified,
         regexp_replace(url, '#.*$', '') AS bare
  FROM pages),
r AS (
  SELECT page_id * 4 AS record_id, url, t0 AS ts, 'response' AS kind, CASE WHEN page_id % 13 = 7 THEN 404 ELSE 200 END AS status,
         '"' || tag || '"' AS etag, modified AS last_modified, 'max-age=60' AS cache, CAST(NULL AS BIGINT) AS expires,
         octet_length(encode(html)) AS size, sha256(html) AS digest
  FROM p
  UNION ALL
  SELECT page_id * 4 + 1, bare || '#again', t0 + 86400 * (1 + page_id % 3), 'revisit', 304, 'W/"' || tag || '"', NULL,
         'max-age=120', t0 + 86400 * (1 + page_id % 3) + 120, NULL, NULL
  FROM p
  UNION ALL
  SELECT page_id * 4 + 2, bare || CASE WHEN contains(bare, '?') THEN '&' ELSE '?' END || 'utm_source=again', t0 + 864000,
         'revisit', 304, NULL, CASE WHEN page_id % 5 <> 0 THEN modified ELSE t0 + 1 END, NULL, NULL, 0, NULL
  FROM p
  UNION ALL
  SELECT page_id * 4 + 3, url, t0 - 30, 'revisit', 304, '"0"', NULL, NULL, NULL, NULL, NULL
  FROM p WHERE page_id % 7 = 0),
parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
         regexp_replace(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', '') AS rest
  FROM (SELECT *, regexp_replace(url, '#.*$', '') AS u FROM r)),
params AS (
  SELECT record_id, string_agg(q, '&' ORDER BY q) AS query
  FROM (SELECT record_id, unnest(string_split(regexp_extract(rest, '\?(.*)$', 1), '&')) AS q FROM parts)
  WHERE q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)')
  GROUP BY record_id),
k AS (
  SELECT parts.*, CASE WHEN host = '' THEN u ELSE host || regexp_replace(regexp_replace(rest, '\?.*$', ''), '/+$', '')
         || coalesce('?' || query, '') END AS url_key
  FROM parts LEFT JOIN params ON parts.record_id = params.record_id),
ranked AS (
  SELECT v.record_id, v.url_key, v.ts, v.etag, v.last_modified, v.cache, v.expires,
         b.record_id AS base_id, b.ts AS b_date, b.etag AS b_etag, b.last_modified AS b_modified, b.cache AS b_cache, b.size AS b_size,
         b.digest AS b_digest, row_number() OVER (PARTITION BY v.record_id ORDER BY b.ts DESC, b.record_id DESC) AS rn
  FROM (SELECT * FROM k WHERE kind = 'revisit') v
  LEFT JOIN (SELECT * FROM k WHERE kind = 'response' AND status = 200) b ON b.url_key = v.url_key AND b.ts < v.ts),
o AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'orphan'
                 WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = replace(b_etag, 'W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = b_modified THEN 'resolved' ELSE 'mismatch' END
                 WHEN b_etag IS NULL AND b_modified IS NULL THEN 'resolved' ELSE 'unverified' END AS outcome
  FROM ranked WHERE rn = 1)
SELECT record_id, url_key, ts, base_id, outcome,
       CASE WHEN outcome = 'resolved' THEN
         'cache-control: ' || coalesce(cache, b_cache) || chr(10) || 'content-length: ' || b_size || chr(10)
         || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || coalesce(etag, b_etag) || chr(10)
         || coalesce('expires: ' || expires || chr(10), '') || 'last-modified: ' || b_modified || chr(10) || 'server: origin' END AS headers,
       CASE WHEN outcome = 'resolved' THEN b_digest END AS digest
FROM o
"""
