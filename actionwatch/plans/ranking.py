"""Ranking, top-k, page and order queries (WIN-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lists import also_line, primary
from ..functions.text import primary_and_press
from ..operators import filters as gates
from ..operators import joins
from ..operators import ranking as op
from ..sources import fixtures as fx
from ..sources.fixtures import AS_OF, COMPETENCIES, with_
from .aggregates import CLUSTERS, clusters, stored
from .registry import query

IN_WINDOW = "date >= DATE '2024-01-24' AND date < DATE '2024-01-31'"
TOP = f"""picked AS (SELECT *, row_number() OVER (PARTITION BY competency[1] ORDER BY relevance DESC, article_count DESC, date DESC, event_id) AS rank
  FROM ev WHERE {IN_WINDOW} AND len(competency) > 0 AND relevance >= 2)"""


def window_events(t):
    return gates.half_open(fx.events(t), date="date", as_of=AS_OF, days=7)


@query("WIN-01", with_("ev") + f", {TOP} SELECT competency[1] AS category, CAST(rank AS INTEGER) AS rank, event_id, relevance, article_count, date FROM picked WHERE rank <= 4")
def top_events(t):
    return op.top_per_category(window_events(t), choices=COMPETENCIES).select(F.col("primary").alias("category"), "rank", "event_id", "relevance", "article_count", "date")


GOVERNORS = with_("roster", "devs") + """, c AS (SELECT devs.* FROM devs JOIN roster USING (state, candidate) WHERE status NOT IN ('withdrawn', 'defeated') AND (race_rating = 'Toss-up' OR race_rating LIKE 'Lean%') AND relevance >= 2)
"""


@query("WIN-02", GOVERNORS + "SELECT event_id, candidate, relevance, article_count, date, (SELECT greatest(count(*) - 4, 0) FROM c) AS overflow FROM c ORDER BY relevance DESC, article_count DESC, date DESC, event_id LIMIT 4")
def _(t):
    return op.top_governors(fx.developments(t), fx.roster(t)).select("event_id", "candidate", "relevance", "article_count", "date", "overflow")


@query("WIN-03", CLUSTERS + """, r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY event_date NULLS LAST, shared DESC, pos, event_id) AS n, count(*) OVER (PARTITION BY cluster_id) AS candidates FROM matched)
SELECT cluster_id, event_id, shared, candidates FROM r WHERE n = 1""")
def _(t):
    return op.choose_owner(joins.match_owners(clusters(t), stored(t)))


REVIEWED = with_("raw") + ", rows AS (SELECT url AS key, row_id, k % 11 = 0 AND row_id % 3 = 0 AS reviewed, ingested_at FROM raw)\n"


@query("WIN-04", REVIEWED + "SELECT key, row_id FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY reviewed DESC, ingested_at DESC, row_id) AS n FROM rows) WHERE n = 1")
def _(t):
    rows = fx.raw(t).select(F.col("url").alias("key"), "row_id", ((F.col("k") % 11 == 0) & (F.col("row_id") % 3 == 0)).alias("reviewed"), "ingested_at")
    return op.keep_best(rows, key="key", order=[F.desc("reviewed"), F.desc("ingested_at"), F.asc("row_id")]).select("key", "row_id")


@query("WIN-05", with_("ev") + "SELECT state, event_id FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY date, article_count DESC, event_id) AS n FROM ev) WHERE n = 1")
def _(t):
    return op.keep_best(fx.events(t), key="state", order=[F.asc("date"), F.desc("article_count"), F.asc("event_id")]).select("state", "event_id")


@query("WIN-06", with_("raw") + """, u AS (SELECT row_id, seq, CASE WHEN k % 13 = 0 THEN '' ELSE url END AS url FROM raw)
SELECT url, min(row_id) AS row_id FROM u WHERE url <> '' GROUP BY 1 UNION ALL SELECT url, row_id FROM u WHERE url = ''""")
def _(t):
    rows = fx.raw(t).select("row_id", "seq", F.when(F.col("k") % 13 == 0, "").otherwise(F.col("url")).alias("url"))
    return op.keep_first_url(rows).select("url", "row_id")


@query("WIN-07", with_("ev") + "SELECT candidate, event_id FROM (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY date DESC, event_id) AS n FROM ev) WHERE n <= 20")
def _(t):
    return op.top_per_group(fx.events(t), group=["candidate"], order=[F.desc("date"), F.asc("event_id")], cap=20).select("candidate", "event_id")


@query("WIN-08", with_("items") + "SELECT item_id FROM items ORDER BY seq LIMIT 60")
def _(t):
    return fx.items(t).orderBy("seq").limit(60).select("item_id")


@query("WIN-10", with_("ev") + "SELECT event_id, date, relevance, row_number() OVER (ORDER BY date DESC, relevance DESC NULLS LAST, event_id) AS rank FROM ev")
def _(t):
    return op.ranked(fx.events(t).select("event_id", "date", "relevance"), order=[F.desc("date"), F.desc_nulls_last("relevance"), F.asc("event_id")])


@query("WIN-11", with_("bills") + "SELECT bill, pos, committee, relevance, date, row_number() OVER (ORDER BY relevance DESC, date DESC, bill, pos, committee) AS rank FROM bills")
def _(t):
    rows = fx.bills(t).select("bill", "pos", "committee", "relevance", "date")
    return op.ranked(rows, order=[F.desc("relevance"), F.desc("date"), F.asc("bill"), F.asc("pos"), F.asc("committee")])


@query("WIN-12", """WITH h AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT * FROM (SELECT 'upcoming' AS part, id, date FROM h WHERE date >= DATE '1997-01-01' ORDER BY date, id LIMIT 4)
UNION ALL SELECT * FROM (SELECT 'recent' AS part, id, date FROM h WHERE date >= DATE '1997-01-01' - 30 AND date < DATE '1997-01-01' ORDER BY date DESC, id LIMIT 4)""")
def hearings(t):
    h = t("orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"))
    today = F.lit("1997-01-01").cast("date")
    upcoming = h.where(F.col("date") >= today).orderBy("date", "id").limit(4).select(F.lit("upcoming").alias("part"), "id", "date")
    recent = h.where((F.col("date") >= F.date_sub(today, 30)) & (F.col("date") < today)).orderBy(F.desc("date"), "id").limit(4).select(F.lit("recent").alias("part"), "id", "date")
    return upcoming.unionByName(recent)


@query("WIN-13", with_("ev") + ", f AS (SELECT * FROM ev WHERE state = 'S7') SELECT event_id, CAST(3 AS INTEGER) AS page, CAST(ceil((SELECT count(*) FROM f) / 10.0) AS INTEGER) AS pages FROM f ORDER BY date DESC, event_id LIMIT 10 OFFSET 20")
def _(t):
    return op.page(fx.events(t).where("state = 'S7'"), order=[F.desc("date"), F.asc("event_id")], number=3).select("event_id", "page", "pages")


@query("WIN-13-deep", with_("ev") + "SELECT event_id, CAST(least(75, ceil((SELECT count(*) FROM ev) / 10.0)) AS INTEGER) AS page, CAST(ceil((SELECT count(*) FROM ev) / 10.0) AS INTEGER) AS pages FROM ev ORDER BY date DESC, event_id LIMIT 10 OFFSET (SELECT least(74, CAST(ceil(count(*) / 10.0) AS INTEGER) - 1) * 10 FROM ev)")
def _(t):
    """A page far in the whole table, read from its own range."""
    pages = op.Pages(fx.events(t).select("event_id", "date"), order=[F.desc("date"), F.asc("event_id")])
    return pages.page(75).select("event_id", "page", "pages")


@query("WIN-14", with_("ev") + "SELECT event_id, date FROM ev WHERE state = 'S11' ORDER BY date DESC, event_id LIMIT 5")
def _(t):
    return fx.events(t).where("state = 'S11'").orderBy(F.desc("date"), "event_id").limit(5).select("event_id", "date")


STATUS_ORDER = ["incumbent", "nominee", "running", "declared"]


@query("WIN-15", with_("roster") + """, r AS (SELECT candidate, state, party, CASE status WHEN 'incumbent' THEN 1 WHEN 'nominee' THEN 2 WHEN 'running' THEN 3 WHEN 'declared' THEN 4 ELSE 5 END AS status_rank FROM roster)
SELECT candidate, state, CAST(row_number() OVER (PARTITION BY state ORDER BY status_rank, party, candidate) AS INTEGER) AS place FROM r""")
def _(t):
    ranked = fx.roster(t).withColumn("status_rank", op.place_in("status", STATUS_ORDER))
    return op.placed_in_group(ranked, group=["state"], order=[F.asc("status_rank"), F.asc("party"), F.asc("candidate")], rank="place").select("candidate", "state", "place")


@query("WIN-16", """SELECT p_partkey AS id, v, row_number() OVER (ORDER BY CASE WHEN regexp_matches(v, '^[0-9]{1,9}$') THEN CAST(v AS INTEGER) END NULLS LAST, v, p_partkey) AS rank FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS v FROM part)""".replace("CAST(v AS INTEGER)", "TRY_CAST(v AS INTEGER)"))
def _(t):
    v = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    return op.ranked(t("part").select(F.col("p_partkey").alias("id"), v.alias("v")), order=[*op.numeric_then_text("v"), F.asc("id")])


@query("WIN-17", with_("ev") + "SELECT event_id, relevance, date, row_number() OVER (ORDER BY relevance DESC NULLS LAST, date DESC, event_id) AS rank FROM ev WHERE date >= DATE '2024-01-20'")
def _(t):
    rows = fx.events(t).where("date >= '2024-01-20'").select("event_id", "relevance", "date")
    return op.ranked(rows, order=[F.desc_nulls_last("relevance"), F.desc("date"), F.asc("event_id")])


@query("WIN-18", with_("ev") + f", {TOP} SELECT competency[1] AS category, event_id FROM picked WHERE rank = 1 AND relevance = 3")
def must_cover(t):
    return top_events(t).where("rank = 1 and relevance = 3").select("category", "event_id")


@query("WIN-19", "SELECT event_id, attempts, attempts > 2 AS limited FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) AS attempts FROM events)")
def _(t):
    return op.sliding_count(t("events"), key="user_id", ts="ts", seconds=6 * 3600, most=2).select("event_id", "attempts", "limited")


@query("WIN-20", with_("raw") + """, u AS (SELECT row_id, k, CASE WHEN k % 2 = 0 THEN 'https://www.a' || k || '.gov/x' ELSE 'https://p' || k || '.example/x' END AS first, CASE WHEN k % 3 = 0 THEN 'https://b.gov/y' ELSE 'https://q.example/y' END AS second FROM raw)
SELECT row_id, CASE WHEN k % 2 = 0 OR k % 3 <> 0 THEN first || '|' || second ELSE second || '|' || first END AS shown FROM u""")
def _(t):
    k = F.col("k")
    first = F.when(k % 2 == 0, F.concat(F.lit("https://www.a"), k, F.lit(".gov/x"))).otherwise(F.concat(F.lit("https://p"), k, F.lit(".example/x")))
    second = F.when(k % 3 == 0, "https://b.gov/y").otherwise("https://q.example/y")
    return fx.raw(t).select("row_id", F.array_join(primary_and_press(F.array(first, second)), "|").alias("shown"))


@query("FUN-27", with_("ev") + """SELECT event_id, CASE WHEN len(competency) > 1 THEN 'also ' || array_to_string(list_filter(['civil-service', 'procedure', 'digital', 'incentives'], lambda c: list_contains(competency, c) AND c <> competency[1]), ' & ') ELSE '' END AS also FROM ev""")
def _(t):
    return fx.events(t).select("event_id", also_line(F.col("competency"), COMPETENCIES).alias("also"))


@query("FUN-28", with_("ev") + "SELECT event_id, competency[1] AS category FROM ev")
def _(t):
    return fx.events(t).select("event_id", primary(F.col("competency"), COMPETENCIES).alias("category"))
