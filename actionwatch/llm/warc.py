"""Resolving not-modified revisits of a crawl to the full responses that they confirm.

A revisit record (a 304 answer) has no body. It belongs to the latest earlier full response with the same canonical
URL. The two are compared by validators, and the stored headers are updated with those that a 304 may carry.

The as-of join is DataFrame functions only. Records are dealt into ranges of (URL, time), whose borders follow their
number: within (URL, range) a window finds the latest response; a second, small table of the last response of each
(URL, range) is carried forward over ranges. So a URL that holds a large share of all records, at whatever times, lies
in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .url_filter import canonical

#: Headers that a 304 may update (fixed values of the HTTP standard).
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]

RECORDS = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, payload long"


def _header(headers: Column, name: str) -> Column:
    """A header's value, trimmed; null where missing or empty. Names are in lower case."""
    return F.nullif(F.trim(F.try_element_at(headers, F.lit(name))), F.lit(""))


def _weak(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then clash the last by name order stays. Null is empty."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.lower(e["key"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def resolve_revisits(records: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """One row for each revisit of ``records`` (see ``RECORDS``): what it confirms and its merged headers.

    Returns record_id, canonical_url, ts, resolution, target_id, payload, headers. ``resolution``:

    - ``orphan``: no full response (kind ``response``, status 200) of the URL comes before; a URL without ``://``, a
      null URL or a null time is one too;
    - ``mismatch``: both have an entity tag (else both a Last-Modified) and they differ;
    - ``unverified``: no validator stands on both sides;
    - ``resolved``: the validators agree.

    Order is by (ts, record_id); equal times are told apart by record_id. Only resolved and unverified revisits have
    a payload; only resolved ones take over headers, others keep their own. Repeated revisits all come out; of
    repeated responses either may be the target, as they are equal. Other columns are not read.
    """
    url = canonical(F.col("url"))
    plain = records.select("record_id", url.alias("canonical_url"), "ts", "kind", "status", lower_names(F.col("headers")).alias("headers"), "payload")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    placed = plain.where(F.col("canonical_url").isNotNull() & F.col("ts").isNotNull() & (full | (F.col("kind") == "revisit")))
    response = F.when(full, F.struct("ts", "record_id", "payload", "headers"))
    # Ranges of (URL, time, record): a URL of very many records lies in many of them. Written, as all readings below must
    # see the same ranges.
    order = [F.col("canonical_url"), F.col("ts"), F.col("record_id"), F.desc("kind")]
    ordered = placed.repartitionByRange(*([ranges] if ranges else []), *order)
    placed = materialize(ordered.withColumn("bucket", F.spark_partition_id()), "crawl-ranges").withColumn("response", response)

    order = Window.partitionBy("canonical_url", "bucket").orderBy("ts", "record_id", F.desc("kind"))
    near = placed.withColumn("near", F.last("response", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))).where(F.col("kind") == "revisit")

    # The last response of each bucket, carried to later buckets of the URL.
    ends = placed.where(F.col("response").isNotNull()).groupBy("canonical_url", "bucket").agg(F.max_by("response", F.struct("ts", "record_id")).alias("end"))
    asked = near.where(F.col("near").isNull()).select("canonical_url", "bucket").distinct().withColumn("end", F.lit(None).cast(ends.schema["end"].dataType))
    steps = ends.unionByName(asked).groupBy("canonical_url", "bucket").agg(F.first("end", ignorenulls=True).alias("end"))
    over = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("far", F.last("end", ignorenulls=True).over(over)).select("canonical_url", "bucket", "far")
    found = near.join(carried, ["canonical_url", "bucket"], "left").withColumn("target", F.coalesce("near", "far"))

    tag, since = _header(F.col("headers"), "etag"), _header(F.col("headers"), "last-modified")
    old_tag, old_since = _header(F.col("target.headers"), "etag"), _header(F.col("target.headers"), "last-modified")
    agree = F.when(tag.isNotNull() & old_tag.isNotNull(), _weak(tag) == _weak(old_tag)).when(since.isNotNull() & old_since.isNotNull(), since == old_since)
    resolution = F.when(F.col("target").isNull(), "orphan").when(agree.isNull(), "unverified").when(agree, "resolved").otherwise("mismatch")
    update = F.map_filter("headers", lambda k, v: k.isin(PERMITTED))
    kept = F.map_filter("target.headers", lambda k, v: ~F.map_contains_key(update, k))
    resolved = F.col("resolution") == "resolved"
    found = found.withColumn("resolution", resolution).select(
        "record_id", "canonical_url", "ts", "resolution",
        F.col("target.record_id").alias("target_id"),
        F.when(F.col("resolution").isin("resolved", "unverified"), F.col("target.payload")).alias("payload"),
        F.when(resolved, F.map_concat(kept, update)).otherwise(F.col("headers")).alias("headers"),
    )
    none = F.lit(None).cast("long")
    lost = plain.where((F.col("kind") == "revisit") & (F.col("canonical_url").isNull() | F.col("ts").isNull()))
    lost = lost.select("record_id", "canonical_url", "ts", F.lit("orphan").alias("resolution"), none.alias("target_id"), none.alias("payload"), "headers")
    return found.unionByName(lost)


def crawl_log(pages: DataFrame) -> DataFrame:
    """A crawl log derived from a table of pages: a full response for each page, and a later revisit of its URL.

    The time of a page is its id. A digest of the URL decides how much later the revisit comes (for one in eleven:
    before), and which validators it carries: an entity tag (two thirds), a date, or none.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    pick = F.conv(F.substring(F.md5(url), 1, 6), 16, 10).cast("long")
    tag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")), "yyyy-MM-dd")
    base = pages.select("page_id", "url", pick.alias("pick"), tag.alias("tag"), day.alias("day"), F.octet_length(html).alias("size"))
    ts = F.col("page_id") * 100
    header = lambda *kv: F.create_map(*(F.lit(x) if isinstance(x, str) else x for x in kv))
    first = base.select((F.col("page_id") * 2).alias("record_id"), "url", ts.alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"), header("ETag", F.col("tag"), "Last-Modified", F.col("day"), "Content-Type", "text/html", "Content-Length", F.col("size").cast("string"), "Cache-Control", "max-age=60").alias("headers"), F.col("page_id").alias("payload"))
    later = F.when(F.col("pick") % 11 == 0, ts - 50).otherwise(ts + 50 + (F.col("pick") % 50_000))
    common = ["Date", F.concat(F.lit("t"), later.cast("string")), "Content-Length", "0", "Cache-Control", "max-age=600"]
    headers = F.when(F.col("pick") % 3 < 2, header(*common, "ETag", F.concat(F.lit("W/"), F.col("tag")))).when(F.col("pick") % 2 == 0, header(*common, "Last-Modified", F.col("day"))).otherwise(header(*common))
    again = base.select((F.col("page_id") * 2 + 1).alias("record_id"), "url", later.alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), headers.alias("headers"), F.lit(None).cast("long").alias("payload"))
    return first.unionByName(again)


ORACLE_SQL = r"""
WITH base AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS size,
    CAST('0x' || substr(md5(coalesce(url, '')), 1, 6) AS BIGINT) AS pick,
    '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
    strftime(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS day,
    CASE WHEN url LIKE '%://%' THEN
      regexp_replace(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.', '')
      || regexp_replace(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') END AS place,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages
), named AS (
  SELECT *, place || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS c,
    CASE WHEN pick % 11 = 0 THEN page_id * 100 - 50 ELSE page_id * 100 + 50 + pick % 50000 END AS later
  FROM base
), revisits AS (
  SELECT page_id * 2 + 1 AS record_id, c, later AS ts,
    CASE WHEN pick % 3 < 2 THEN tag END AS tag,
    CASE WHEN pick % 3 >= 2 AND pick % 2 = 0 THEN day END AS day
  FROM named
), matched AS (
  SELECT r.record_id, r.c, r.ts, r.tag, r.day, s.page_id, s.tag AS old_tag, s.day AS old_day, s.size,
    row_number() OVER (PARTITION BY r.record_id ORDER BY s.page_id DESC NULLS LAST) AS rn
  FROM revisits r LEFT JOIN named s ON s.c = r.c AND (s.page_id * 100, s.page_id * 2) < (r.ts, r.record_id)
), judged AS (
  SELECT *, CASE WHEN page_id IS NULL THEN 'orphan'
    WHEN tag IS NOT NULL THEN CASE WHEN tag = old_tag THEN 'resolved' ELSE 'mismatch' END
    WHEN day IS NOT NULL THEN CASE WHEN day = old_day THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS resolution
  FROM matched WHERE rn = 1
)
SELECT record_id, c AS canonical_url, ts, resolution, page_id * 2 AS target_id,
  CASE WHEN resolution IN ('resolved', 'unverified') THEN page_id END AS payload,
  CASE WHEN resolution = 'resolved' THEN
    'cache-control: max-age=600|content-length: ' || size || '|content-type: text/html|date: t' || ts
    || '|etag: ' || CASE WHEN tag IS NULL THEN old_tag ELSE 'W/' || tag END || '|last-modified: ' || old_day
  ELSE 'cache-control: max-age=600|content-length: 0|date: t' || ts
    || CASE WHEN tag IS NOT NULL THEN '|etag: W/' || tag ELSE '' END
    || CASE WHEN day IS NOT NULL THEN '|last-modified: ' || day ELSE '' END END AS headers
FROM judged
"""
