"""Streaming (STR-*) and user-function (UDF-*) queries. Streams read landed files and run to their end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates, udf
from ..operators.shared import shared_folder
from ..sources import fixtures as fx
from ..sources import keyed
from ..sources.fixtures import with_
from ..streaming import clusters, stream
from .aggregates import STORED, stored
from .lifecycle import ACCRETE, CLUSTERED, snapshot
from .registry import query


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _land(df, files: int = 3) -> tuple[str, object]:
    """The rows as landed files in order of ingestion."""
    rows = df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    path = _folder(df.sparkSession, "landing")
    rows.repartitionByRange(files, "ingested_at").write.parquet(path)
    return path, rows.schema


def _land_in_order(df, files: int = 3) -> tuple[str, object]:
    """As ``_land``, one file after the other: streams take files in the order of their times."""
    rows = df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    path, at = _folder(df.sparkSession, "landing"), F.unix_micros("ingested_at")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    part = F.least(F.floor((at - low) * files / ((high or 0) - (low or 0) + 1)), F.lit(files - 1))
    for k in range(files):
        rows.where(part == k).repartitionByRange(1, "ingested_at").write.mode("append").parquet(path)
    return path, rows.schema


@query("STR-01", with_("raw") + "SELECT row_id, url FROM raw")
def _(t):
    r = fx.raw(t)
    spark = r.sparkSession
    path, schema = _land(r)
    out = _folder(spark, "ingested")
    stream.run(stream.landed(spark, path, schema, files_per_batch=1).select("row_id", "url"), _folder(spark, "progress"), path=out)
    return spark.read.parquet(out)


@query("STR-02", with_("raw") + "SELECT DISTINCT url FROM raw WHERE url NOT IN (SELECT url FROM raw WHERE k % 10 = 0)")
def _(t):
    r = fx.raw(t)
    spark = r.sparkSession
    path, schema = _land(r)
    out = _folder(spark, "unseen")
    fresh = stream.first_seen(stream.landed(spark, path, schema, files_per_batch=1)).select("url")
    known = r.where("k % 10 = 0").select("url").distinct()
    stream.run(fresh, _folder(spark, "progress"), each=stream.append_unseen(out, known, parts=16))
    return spark.read.parquet(out).select("url")


@query("STR-03", with_("raw") + "SELECT url, count(*) FILTER (CAST(ingested_at AS DATE) - date > 7) AS late, count(*) AS n FROM raw GROUP BY 1")
def _(t):
    r = fx.raw(t)
    spark = r.sparkSession
    path, schema = _land(r)
    out = _folder(spark, "late")
    # Rows are placed by ingestion; however old an article's own date is, none is dropped as late.
    rows = stream.landed(spark, path, schema, files_per_batch=1).withWatermark("ingested_at", "1 day").select("url", (F.datediff(F.to_date("ingested_at"), "date") > 7).alias("late"))
    stream.run(rows, _folder(spark, "progress"), path=out)
    return spark.read.parquet(out).groupBy("url").agg(F.count_if("late").alias("late"), F.count(F.lit(1)).alias("n"))


@query("STR-04", ACCRETE)
def _(t):
    spark = t("events").sparkSession
    events = _folder(spark, "events")
    keyed.create(stored(t).select("event_id", "source_urls", F.array(F.lit("first")).alias("source_outlets"), "date"), events, key="event_id", buckets=8)

    def gather(batch):
        rows = batch.select(F.concat(F.lit("e"), F.substring(F.sha1("url"), 1, 15)).alias("event_id"), "seq", F.concat(F.lit("https://new.example/"), "lane").alias("add"), "lane")
        return rows.groupBy("event_id").agg(aggregates.ordered_distinct("add", ["seq"]).alias("source_urls"), aggregates.ordered_distinct("lane", ["seq"]).alias("source_outlets"))

    path, schema = _land(fx.raw(t).where("ingested_at >= '2024-01-20'"), files=2)
    stream.run(stream.landed(spark, path, schema, files_per_batch=1), _folder(spark, "progress"), each=stream.keyed_accretion(events, gather))
    return keyed.read(spark, events).select("event_id", "date", F.array_join("source_urls", "|").alias("urls"))


@query("STR-04-clusters", CLUSTERED)
def _(t):
    d = t("documents").select("lang", "doc_id", "text")
    spark = d.sparkSession
    landing, state = _folder(spark, "landing"), _folder(spark, "clusters")
    d.repartition(3, "doc_id").write.parquet(landing)
    stream.run(stream.landed(spark, landing, d.schema, files_per_batch=1), _folder(spark, "progress"), each=clusters.grow(state, group="lang", row="doc_id", text="text", parts=8))
    return clusters.read_clusters(spark, state).select("lang", "doc_id", "cluster")


@query("STR-05", with_("raw") + "SELECT CAST(ingested_at AS DATE) AS day, outlet, count(*) AS n FROM raw GROUP BY 1, 2")
def _(t):
    r = fx.raw(t)
    spark = r.sparkSession
    path, schema = _land_in_order(r)
    table = _folder(spark, "funnel")
    counts = stream.daily_funnel(stream.landed(spark, path, schema, files_per_batch=1), source="outlet")
    stream.run(counts, _folder(spark, "progress"), each=stream.funnel_batches(table, source="outlet"), mode="update")
    return keyed.read(spark, table).drop("id")


@query("STR-06", "SELECT event_id AS id, attempts, attempts > 2 AS limited FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) AS attempts FROM events)")
def _(t):
    e = t("events").select("event_id", "user_id", F.col("ts").alias("ingested_at"))
    spark = e.sparkSession
    path, schema = _land(e)
    out = _folder(spark, "limits")
    limits = stream.rate_limits(stream.landed(spark, path, schema), key="user_id", id_column="event_id", ts="ingested_at", seconds=6 * 3600, most=2)
    stream.run(limits, _folder(spark, "progress"), path=out)
    return spark.read.parquet(out)


@query("STR-07", STORED + """SELECT count(*) AS rows, CAST(2 AS BIGINT) AS version FROM (SELECT url FROM raw WHERE (ingested_at < TIMESTAMP '2024-01-20' AND k % 10 <> 0) OR ingested_at >= TIMESTAMP '2024-01-20' GROUP BY 1)""")
def _(t):
    old, new = snapshot(t)
    spark = old.sparkSession
    table = _folder(spark, "table")
    keyed.create(old, table, key="id", buckets=8)
    # The batch lands once, and is streamed twice by runs that know nothing of each other; the second writes no version.
    landing = _folder(spark, "landing")
    new.write.parquet(landing)
    for _ in range(2):
        arrived = stream.landed(spark, landing, new.schema)
        stream.run(arrived, _folder(spark, "progress"), each=stream.keyed_upserts(table, order="seq", preserve=["note"]))
    return keyed.read(spark, table).agg(F.count(F.lit(1)).alias("rows"), F.lit(keyed.number(spark, table)).cast("long").alias("version"))


def _score(row: dict) -> dict:
    """A gate that fails on some rows."""
    if row["item_id"] % 10 == 3:
        raise ValueError("no answer")
    return {"passed": row["item_id"] % 2 == 0, "reason": f"words {len(row['title'].split())}"}


@query("UDF-01", with_("items") + "SELECT item_id, CASE WHEN item_id % 10 <> 3 THEN item_id % 2 = 0 END AS passed, item_id % 10 = 3 AS failed FROM items")
def _(t):
    out = udf.score_rows(fx.items(t).select("item_id", "title"), _score, key="item_id", result="passed boolean, reason string")
    return out.select("item_id", "passed", (F.col("error").isNotNull()).alias("failed"))


#: Parsers of three kinds of pages, by name.
PARSERS = {
    "title": lambda html: F.trim(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1)),
    "heading": lambda html: text.strip_html(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1)),
    "first_link": lambda html: F.regexp_extract(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1),
}


@query("UDF-02", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1))
  WHEN 1 THEN trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))
  WHEN 2 THEN regexp_extract(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1) END AS parsed FROM pages""")
def _(t):
    named = t("pages").withColumn("parser", fx.pick(["title", "heading", "first_link", "unknown"], F.col("page_id")))
    return udf.parse_pages(named, PARSERS).select("page_id", "parsed")


def _by_url(rows):
    return rows.assign(cluster=rows.groupby("url")["row_id"].transform("min"))[["grp", "url", "cluster"]]


@query("UDF-03", with_("raw") + "SELECT grp, row_id, min(row_id) OVER (PARTITION BY grp, url) AS cluster FROM raw")
def _(t):
    # Rows that the function treats alike are one before it: a group's part in a task is its different URLs.
    r = fx.raw(t).select("grp", "row_id", "url")
    once = r.groupBy("grp", "url").agg(F.min("row_id").alias("row_id"))
    found = udf.cluster_groups(once, _by_url, group="grp", schema="grp long, url string, cluster long")
    return r.join(found, ["grp", "url"]).select("grp", "row_id", "cluster")
