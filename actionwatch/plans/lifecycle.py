"""Lifecycle queries (LIF-*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import event_id
from ..operators import joins
from ..operators import lifecycle as op
from ..operators.clustering import cluster
from ..operators.ranking import keep_best
from ..operators.shared import shared_folder
from ..sources import dated, keyed
from ..sources import fixtures as fx
from ..sources.fixtures import AS_OF, COMPETENCIES, with_
from ..sources.tables import append_raw
from .aggregates import STORED, batch, stored
from .registry import query


def folder(spark, name: str) -> str:
    """A new folder for a stored table of a query."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("LIF-01", with_("raw") + "SELECT row_id FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-24'")
def _(t):
    return op.recent(fx.raw(t), as_of=AS_OF, days=7).select("row_id")


TRIGGER = with_("raw") + """, seen AS (SELECT DISTINCT url FROM raw WHERE ingested_at < TIMESTAMP '2024-01-29'),
fresh AS (SELECT DISTINCT grp FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-29' AND url NOT IN (SELECT url FROM seen WHERE NOT regexp_matches(url, '7$')))
"""


@query("LIF-02", TRIGGER + "SELECT row_id, grp FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-21' AND grp IN (SELECT grp FROM fresh)")
def _(t):
    layer = folder(t("events").sparkSession, "raw")
    append_raw(fx.raw(t), layer, group="grp", buckets=16)
    r = t("events").sparkSession.read.parquet(layer)
    seen = r.where("ingested_at < '2024-01-29'").where(~F.col("url").rlike("7$")).select("url").distinct()
    return op.trigger_and_context(r, seen, group="grp", as_of=AS_OF, trigger_days=2, context_days=10, bucket="group_bucket").select("row_id", "grp")


@query("LIF-03", with_("ev") + "SELECT event_id, coalesce(list_min(list_filter(agency, lambda a: a NOT IN ('opm', 'a1'))), list_min(agency), '(unattributed)') AS grp FROM ev")
def _(t):
    return fx.events(t).select("event_id", op.agency_group(F.col("agency"), ["opm", "a1"]).alias("grp"))


CLUSTERED = """WITH RECURSIVE w AS (SELECT lang, doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS p FROM documents),
s AS (SELECT lang, doc_id, list_distinct(CASE WHEN len(p) <= 3 THEN [array_to_string(p, ' ')] ELSE list_transform(range(1, len(p) - 1), lambda i: p[i] || ' ' || p[i + 1] || ' ' || p[i + 2]) END) AS g FROM w WHERE len(p) > 0),
x AS (SELECT lang, doc_id, len(g) AS n, unnest(g) AS h FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.lang = b.lang AND a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.7 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a)
SELECT lang, doc_id, coalesce((SELECT min(other) FROM reach WHERE node = doc_id), doc_id) AS cluster FROM documents"""


@query("LIF-04", CLUSTERED)
def _(t):
    return cluster(t("documents").select("lang", "doc_id", "text"), group="lang", row="doc_id", text="text")


@query("LIF-05", with_("raw") + "SELECT row_id, activity_type || ' — b' AS title FROM raw")
def _(t):
    name = F.concat(F.lit("MD — "), "activity_type", F.lit(" — b"))
    return fx.raw(t).select("row_id", op.singleton_title(name).alias("title"))


@query("LIF-06", with_("raw") + """, u AS (SELECT grp, url, min(seq) AS s FROM raw GROUP BY 1, 2)
SELECT grp, substr(sha1(string_agg(url, chr(10) ORDER BY url)), 1, 16) AS event_id, string_agg(url, '|' ORDER BY s) AS urls, CAST(count(*) AS INTEGER) AS article_count, (SELECT min(date) FROM raw r WHERE r.grp = u.grp) AS date FROM u GROUP BY grp""")
def _(t):
    return op.build_events(fx.raw(t), key="grp").select("grp", "event_id", F.array_join("source_urls", "|").alias("urls"), "article_count", "date")


@query("LIF-06-repeats", with_("raw") + "SELECT grp, substr(sha1(string_agg(url, chr(10) ORDER BY url)), 1, 16) AS event_id, CAST(count(*) AS INTEGER) AS article_count FROM raw GROUP BY grp")
def _(t):
    return op.build_events(fx.raw(t), key="grp", distinct_ids=False).select("grp", "event_id", "article_count")


SNAP = with_("raw") + """, old AS (SELECT url AS id, max(seq) AS seq, CASE WHEN min(k) % 11 = 0 THEN 'checked' ELSE '' END AS note, arg_max(lane, seq) AS lane FROM raw WHERE ingested_at < TIMESTAMP '2024-01-20' AND k % 10 <> 0 GROUP BY 1),
new AS (SELECT url AS id, max(seq) AS seq, '' AS note, arg_max(CASE WHEN seq % 2 = 0 THEN activity_type ELSE lane END, seq) AS lane FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-20' GROUP BY 1)
"""


def snapshot(t):
    r = fx.raw(t)
    old = r.where("ingested_at < '2024-01-20' and k % 10 <> 0").groupBy(F.col("url").alias("id")).agg(F.when(F.min("k") % 11 == 0, "checked").otherwise("").alias("note"), F.max_by("lane", "seq").alias("lane"))
    new = r.where("ingested_at >= '2024-01-20'").select(F.col("url").alias("id"), "seq", F.lit("").alias("note"), F.when(F.col("seq") % 2 == 0, F.col("activity_type")).otherwise(F.col("lane")).alias("lane"))
    return old, new


UPSERT = SNAP + """SELECT id, CASE WHEN old.note <> '' THEN old.note WHEN new.id IS NULL THEN old.note ELSE new.note END AS note, CASE WHEN new.id IS NULL THEN old.lane ELSE new.lane END AS lane,
  CASE WHEN old.id IS NULL THEN 'created' WHEN new.id IS NULL OR old.lane = new.lane THEN 'unchanged' ELSE 'updated' END AS change FROM old FULL JOIN new USING (id)"""


@query("LIF-07", UPSERT)
def lif_07(t):
    old, new = snapshot(t)
    return op.upsert(old, new, key="id", order="seq", preserve=["note"])


ACCRETE = STORED + """, add AS (SELECT 'e' || substr(sha1(url), 1, 15) AS event_id, lane AS kind, min(seq) AS s, 'https://new.example/' || lane AS url FROM batch GROUP BY 1, 2, 4)
SELECT event_id, stored.date, stored.url || coalesce((SELECT '|' || string_agg(url, '|' ORDER BY s) FROM add WHERE add.event_id = stored.event_id), '') AS urls FROM stored"""


def additions(t):
    b = batch(t).select(F.concat(F.lit("e"), F.substring(F.sha1("url"), 1, 15)).alias("event_id"), "seq", F.concat(F.lit("https://new.example/"), "lane").alias("add"), "lane")
    from ..operators.aggregates import ordered_distinct

    return b.groupBy("event_id").agg(ordered_distinct("add", ["seq"]).alias("source_urls"), ordered_distinct("lane", ["seq"]).alias("source_outlets"), F.max_by("lane", "seq").alias("headline"))


def old_events(t):
    return stored(t).select("event_id", "source_urls", F.array(F.lit("first")).alias("source_outlets"), "date", F.lit("frozen").alias("headline"))


@query("LIF-08", ACCRETE)
def _(t):
    return op.accrete(old_events(t), additions(t)).select("event_id", "date", F.array_join("source_urls", "|").alias("urls"))


@query("LIF-09", STORED + ", h AS (SELECT 'e' || substr(sha1(url), 1, 15) AS event_id, arg_max(lane, seq) AS headline FROM batch GROUP BY 1) SELECT event_id, coalesce(h.headline, 'frozen') AS headline FROM stored LEFT JOIN h USING (event_id)")
def _(t):
    return op.accrete(old_events(t), additions(t), regenerated=["headline"]).select("event_id", "headline")


@query("LIF-10", STORED + "SELECT grp AS cluster_id, count(DISTINCT event_id) AS owners FROM batch JOIN stored USING (url) GROUP BY 1 HAVING count(DISTINCT event_id) > 1")
def _(t):
    from .aggregates import clusters

    return joins.match_owners(clusters(t), stored(t)).groupBy("cluster_id").agg(F.count_distinct("event_id").alias("owners")).where("owners > 1")


@query("LIF-11", STORED + """, produced AS (SELECT DISTINCT 'e' || substr(sha1(url), 1, 15) AS event_id FROM batch WHERE k % 2 = 0), done AS (SELECT DISTINCT url FROM batch)
SELECT event_id, CASE WHEN seq % 4 = 0 THEN 'report' ELSE 'delete' END AS action FROM stored WHERE event_id NOT IN (SELECT event_id FROM produced) AND url IN (SELECT url FROM done)""")
def _(t):
    old = stored(t).withColumn("review_status", F.when(F.col("seq") % 4 == 0, "confirmed").otherwise("unreviewed"))
    b = batch(t)
    produced = b.where("k % 2 = 0").select(F.concat(F.lit("e"), F.substring(F.sha1("url"), 1, 15)).alias("event_id")).distinct()
    return op.prune(old, produced, joins.all_contained(old, b.select("url"))).select("event_id", "action")


@query("LIF-12", with_("raw") + """, f AS (SELECT least(min(date), DATE '2024-01-24') AS floor FROM raw WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-24')
SELECT row_id, 'old' AS origin FROM raw, f WHERE k % 2 = 0 AND (k % 14 = 0 OR date < floor) UNION ALL SELECT row_id, 'new' FROM raw, f WHERE k % 2 = 1 AND date >= floor""")
def _(t):
    r = fx.raw(t)
    clean = r.where("k % 2 = 0").select("row_id", F.lit("old").alias("origin"), F.when(F.col("k") % 14 != 0, F.col("date")).alias("date"))
    rebuilt = r.where("k % 2 = 1").select("row_id", F.lit("new").alias("origin"), "date")
    table = folder(r.sparkSession, "clean")
    dated.create(clean, table)
    dated.rebuild(rebuilt, table, floor=op.rebuild_floor(r, as_of=AS_OF, days=7).first()[0])
    return dated.read(r.sparkSession, table).select("row_id", "origin")


@query("LIF-12-scope", with_("raw") + """, f AS (SELECT least(min(date), DATE '2024-01-24') AS floor FROM raw WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-24')
SELECT row_id, 'old' AS origin FROM raw, f WHERE k % 2 = 0 AND (k % 14 = 0 OR date < floor OR grp % 5 <> 0) UNION ALL SELECT row_id, 'new' FROM raw, f WHERE k % 2 = 1 AND date >= floor AND grp % 5 = 0""")
def _(t):
    r = fx.raw(t)
    clean = r.where("k % 2 = 0").select("row_id", "grp", F.lit("old").alias("origin"), F.when(F.col("k") % 14 != 0, F.col("date")).alias("date"))
    rebuilt = r.where("k % 2 = 1").select("row_id", "grp", F.lit("new").alias("origin"), "date")
    table = folder(r.sparkSession, "clean")
    dated.create(clean, table)
    dated.rebuild(rebuilt, table, floor=op.rebuild_floor(r, as_of=AS_OF, days=7).first()[0], scope=F.col("grp") % 5 == 0)
    return dated.read(r.sparkSession, table).select("row_id", "origin")


@query("LIF-13", STORED + """, g AS (SELECT CAST(seq % 50 AS INTEGER) AS group_no, *, CASE WHEN seq % 6 = 0 THEN 'checked' ELSE '' END AS review FROM stored)
SELECT group_no, arg_min(event_id, (CAST(date AS VARCHAR), event_id)) AS survivor, count(*) AS members, CASE WHEN bool_or(review <> '') THEN 'checked' END AS review_status, count(*) < 2 AS bad FROM g GROUP BY 1""")
def _(t):
    old = stored(t).withColumn("review_status", F.when(F.col("seq") % 6 == 0, "checked").otherwise(""))
    groups = old.select((F.col("seq") % 50).cast("int").alias("group_no"), "event_id")
    return op.human_merge(old, groups).select("group_no", "survivor", "members", "review_status", "bad")


@query("LIF-14", with_("ev") + "SELECT event_id, array_to_string(CASE WHEN k % 2 = 0 THEN agency ELSE ['new'] END, ',') AS tags FROM ev")
def _(t):
    new = F.when(F.col("k") % 2 == 1, F.array(F.lit("new"))).otherwise(F.array().cast("array<string>"))
    return fx.events(t).select("event_id", F.array_join(op.never_downgrade(F.col("agency"), new), ",").alias("tags"))


@query("LIF-15", with_("raw") + "SELECT row_id, CASE WHEN k % 3 = 0 THEN CAST(date AS TIMESTAMP) ELSE ingested_at END AS ingested FROM raw")
def _(t):
    at = F.col("ingested_at").cast("timestamp")
    return fx.raw(t).select("row_id", op.backfill_ingested(F.when(F.col("k") % 3 == 1, at), F.when(F.col("k") % 3 == 2, at), F.col("date")).cast("timestamp_ntz").alias("ingested"))


@query("LIF-16", with_("raw") + "SELECT row_id, CASE WHEN k % 2 = 0 THEN '0123456789abcdef' ELSE substr(sha1(url), 1, 16) END AS id FROM raw")
def _(t):
    return fx.raw(t).select("row_id", op.backfill_id(F.when(F.col("k") % 2 == 0, "0123456789abcdef").otherwise("x1"), F.array("url")).alias("id"))


@query("LIF-17", with_("raw") + "SELECT url, row_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY k % 11 = 0 DESC, ingested_at DESC, row_id) AS n FROM raw) WHERE n > 1")
def _(t):
    r = fx.raw(t)
    kept = keep_best(r, key="url", order=[(F.col("k") % 11 == 0).desc(), F.desc("ingested_at"), F.asc("row_id")]).select("row_id")
    return r.join(kept, "row_id", "left_anti").select("url", "row_id")


@query("LIF-18", with_("ev") + """SELECT event_id, CASE WHEN k % 3 = 0 THEN 'digital' WHEN k % 3 = 1 THEN '' ELSE array_to_string(competency, ',') END AS competency, CASE WHEN k % 3 = 0 THEN 2 WHEN k % 3 = 1 THEN NULL ELSE relevance END AS relevance,
  CASE WHEN k % 3 = 0 THEN 'verdict ' || k ELSE activity_type END AS summary, CASE WHEN k % 3 = 0 THEN repeat('t', 160) ELSE lane END AS short_title, CASE WHEN k % 3 = 0 THEN 'because' WHEN k % 3 = 1 THEN '' ELSE branch END AS why_it_matters,
  CASE WHEN k % 3 = 0 THEN 't1' WHEN k % 3 = 1 THEN '' ELSE array_to_string(topic_tags, ',') END AS topic_tags FROM ev""")
def _(t):
    e = fx.events(t).withColumn("summary", F.col("activity_type")).withColumn("short_title", F.col("lane")).withColumn("why_it_matters", F.col("branch"))
    one, none = F.col("k") % 3 == 0, F.array().cast("array<string>")
    v = e.where("k % 3 < 2").select(
        "event_id", F.when(one, F.array(F.lit("bogus"), F.lit("digital"))).otherwise(F.array(F.lit("bogus"))).alias("competencies"), F.lit("2").alias("relevance"), F.when(one, F.concat(F.lit("verdict "), "k")).otherwise("").alias("summary"),
        F.when(one, F.repeat(F.lit("t"), F.lit(200))).alias("short_title"), F.when(one, "because").alias("why_it_matters"), F.when(one, F.array(F.lit("odd"), F.lit("t1"))).otherwise(none).alias("topic_tags"),
    )
    # Some verdicts come twice.
    v = v.unionByName(v.where("event_id % 5 = 0"))
    out = op.apply_verdict(e, v, key="event_id", choices=COMPETENCIES, tags=[f"t{i}" for i in range(10)])
    return out.select("event_id", F.array_join("competency", ",").alias("competency"), "relevance", "summary", "short_title", "why_it_matters", F.array_join("topic_tags", ",").alias("topic_tags"))


@query("LIF-19", with_("roster") + "SELECT candidate, CASE WHEN candidate_id % 3 = 0 THEN 'Seed' ELSE party END AS party, CASE WHEN candidate_id % 5 <> 0 THEN status END AS status FROM roster")
def _(t):
    r = fx.roster(t)
    old = r.where("candidate_id % 5 <> 0").select("candidate", "party", "status")
    seed = r.select("candidate", F.when(F.col("candidate_id") % 3 == 0, "Seed").when(F.col("candidate_id") % 5 == 0, F.col("party")).otherwise("").alias("party"))
    return op.seed_roster(old, seed, keys=["candidate"], owned=["party"])


SIGNUPS = """WITH old AS (SELECT 'u' || c_custkey || '@x.example' AS email, CASE WHEN c_custkey % 3 = 0 THEN 'unsubscribed' ELSE 'active' END AS status FROM customer),
s AS (SELECT DISTINCT 'u' || user_id || '@x.example' AS email FROM events WHERE user_id % 7 <> 0)
SELECT email, CASE WHEN s.email IS NOT NULL THEN 'active' ELSE old.status END AS status, CASE WHEN s.email IS NULL THEN 'none' WHEN old.email IS NULL THEN 'created' WHEN old.status = 'active' THEN 'none' ELSE 'reactivated' END AS action FROM old FULL JOIN s USING (email)"""


def recipients(t):
    return t("customer").select(F.concat(F.lit("u"), "c_custkey", F.lit("@x.example")).alias("email"), F.when(F.col("c_custkey") % 3 == 0, "unsubscribed").otherwise("active").alias("status"), F.when(F.col("c_custkey") % 3 == 0, "2024-01-01").alias("unsubscribed_at"), F.col("c_custkey").alias("seq"))


@query("LIF-20", SIGNUPS.replace("old.email IS NULL", "old.status IS NULL"))
def _(t):
    signups = t("events").select(F.when(F.col("user_id") % 7 == 0, "not an address").otherwise(F.concat(F.lit(" U"), "user_id", F.lit("@X.example"))).alias("email"), "ts")
    signups = signups.withColumn("email", F.trim("email"))
    return op.subscribe(recipients(t).drop("seq"), signups).select("email", "status", "action")


@query("LIF-21", "SELECT 'u' || c_custkey % 100 || '@x.example' AS address, min(c_custkey) AS seq FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1")
def _(t):
    rows = recipients(t).withColumn("email", F.concat(F.lit("U"), F.col("seq") % 100, F.lit("@x.example")))
    return op.active_recipients(rows)


@query("LIF-21-malformed", "SELECT count(*) FILTER (c_custkey % 3 <> 0 AND c_custkey % 5 = 0) AS malformed FROM customer")
def _(t):
    return op.malformed_recipients(recipients(t).withColumn("email", F.when(F.col("seq") % 5 > 0, F.col("email"))))


@query("SRC-11", SNAP + "SELECT count(*) FILTER (old.id IS NULL) AS created, count(*) FILTER (old.id IS NOT NULL AND new.id IS NOT NULL AND old.lane <> new.lane) AS updated FROM (SELECT * FROM old) old FULL JOIN new USING (id)")
def _(t):
    old, new = snapshot(t)
    table = folder(old.sparkSession, "table")
    keyed.create(old, table, key="id", buckets=16)
    keyed.upsert_into(new, table, order="seq", preserve=["note"])
    # ``seq`` moves with every batch; a row counts as updated where more than that has changed.
    found = keyed.changes(old.sparkSession, table, 1, keyed.number(old.sparkSession, table))
    updated = (F.col("change") == "updated") & ~F.col("old.lane").eqNullSafe(F.col("new.lane"))
    return found.agg(F.count_if(F.col("change") == "created").alias("created"), F.count_if(updated).alias("updated"))


@query("FUN-25-repeats", with_("raw") + "SELECT grp, substr(sha1(string_agg(url, chr(10) ORDER BY url)), 1, 16) AS event_id FROM raw GROUP BY 1")
def _(t):
    return fx.raw(t).groupBy("grp").agg(F.collect_list("url").alias("urls")).select("grp", event_id(F.col("urls")).alias("event_id"))
