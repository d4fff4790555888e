"""Reports (REP-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import digest_item, outlet_summary, state_title
from ..operators import aggregates
from ..operators import filters as gates
from ..operators import ranking
from ..sources import fixtures as fx
from ..sources import keyed
from ..sources.fixtures import COMPETENCIES, with_
from . import ranking as rank_queries
from .aggregates import CALENDARS, joi_09
from .lifecycle import folder
from .ranking import IN_WINDOW, window_events
from .registry import query


SIDES = {"state": ["news", "odd"], "congress": ["oversight"], "agency": ["executive-action", "rulemaking"]}
SIDE = "CASE WHEN lane IN ('news', 'odd') THEN 'state' WHEN lane = 'oversight' THEN 'congress' ELSE 'agency' END"


def side_of(lane):
    return F.when(lane.isin(SIDES["state"]), "state").when(lane.isin(SIDES["congress"]), "congress").otherwise("agency")


@query("REP-01", with_("ev", "roster", "devs", "bills") + f""", win AS (SELECT *, {SIDE} AS side FROM ev WHERE {IN_WINDOW}),
top AS (SELECT *, row_number() OVER (PARTITION BY side, competency[1] ORDER BY relevance DESC, article_count DESC, date DESC, event_id) AS rank FROM win WHERE len(competency) > 0 AND relevance >= 2),
gov AS (SELECT devs.*, row_number() OVER (ORDER BY relevance DESC, article_count DESC, date DESC, event_id) AS rank FROM devs JOIN roster USING (state, candidate)
  WHERE date >= DATE '1997-01-01' - 300 AND date < DATE '1997-01-01' AND len(competency) > 0 AND status NOT IN ('withdrawn', 'defeated') AND (race_rating = 'Toss-up' OR race_rating LIKE 'Lean%') AND relevance >= 2),
mv AS (SELECT bill, row_number() OVER (ORDER BY relevance DESC, coalesce(committee_action_date, date) DESC, bill, pos, committee) AS rank FROM bills
  WHERE coalesce(committee_action_date, date) >= DATE '1997-01-01' - 300 AND coalesce(committee_action_date, date) < DATE '1997-01-01' AND committee_action IN ('marked-up', 'reported') AND relevance >= 2 AND len(competency) > 0),
h AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date FROM orders),
up AS (SELECT id, row_number() OVER (ORDER BY date, id) AS rank FROM h WHERE date >= DATE '1997-01-01'),
past AS (SELECT id, row_number() OVER (ORDER BY date DESC, id) AS rank FROM h WHERE date >= DATE '1997-01-01' - 30 AND date < DATE '1997-01-01')
SELECT side AS section, competency[1] AS category, CAST(rank AS INTEGER) AS rank, event_id AS id FROM top WHERE rank <= 4
UNION ALL SELECT 'governors', '', CAST(rank AS INTEGER), event_id FROM gov WHERE rank <= 4 UNION ALL SELECT 'bills', '', CAST(rank AS INTEGER), bill FROM mv WHERE rank <= 4
UNION ALL SELECT 'upcoming', '', CAST(rank AS INTEGER), id FROM up WHERE rank <= 4 UNION ALL SELECT 'recent', '', CAST(rank AS INTEGER), id FROM past WHERE rank <= 4
UNION ALL SELECT 'total', CASE WHEN side = 'state' THEN 'state' ELSE 'federal' END, 0, count(*) FROM win GROUP BY 2""")
def digest(t):
    """All sections of the weekly digest and its totals as one long table: (section, category, rank, id)."""
    from pyspark.sql import Window

    def numbered(df, section: str, order, key: str):
        # At most four rows: a window over all of them is small.
        best = df.orderBy(*order).limit(4)
        return best.select(F.lit(section).alias("section"), F.lit("").alias("category"), F.row_number().over(Window.orderBy(*order)).alias("rank"), F.col(key).cast("long").alias("id"))

    events = window_events(t).withColumn("side", side_of(F.col("lane")))
    # All sides in one pass.
    best = ranking.top_per_category(events, choices=COMPETENCIES, within=["side"])
    out = best.select(F.col("side").alias("section"), F.col("primary").alias("category"), "rank", F.col("event_id").cast("long").alias("id"))
    developments = gates.half_open(fx.developments(t).where(F.size("competency") > 0), date="date", as_of="1997-01-01", days=300)
    governors = ranking.top_governors(developments, fx.roster(t))
    moved = gates.moved_bills(fx.bills(t), as_of="1997-01-01", days=300, category="competency")
    hearings = rank_queries.hearings(t)
    federal = F.when(F.col("side") == "state", "state").otherwise("federal")
    totals = events.groupBy(federal.alias("category")).agg(F.count(F.lit(1)).alias("id")).select(F.lit("total").alias("section"), "category", F.lit(0).alias("rank"), "id")
    for part in (
        numbered(governors, "governors", [F.desc("relevance"), F.desc("article_count"), F.desc("date"), F.asc("event_id")], "event_id"),
        numbered(moved, "bills", [F.desc("relevance"), F.desc("moved_on"), F.asc("bill"), F.asc("pos"), F.asc("committee")], "bill"),
        numbered(hearings.where("part = 'upcoming'"), "upcoming", [F.asc("date"), F.asc("id")], "id"),
        numbered(hearings.where("part = 'recent'"), "recent", [F.desc("date"), F.asc("id")], "id"),
        totals,
    ):
        out = out.unionByName(part)
    return out


@query("REP-02", with_("ev") + f"""SELECT event_id, state || ': ' || activity_type AS title, CASE WHEN k % 2 = 0 THEN 'Why ' || k || '.' ELSE 'First ' || k || '. Then more.' END AS summary, activity_type || ' · ' || actor_type AS meta, relevance,
  CASE WHEN len(agency) > 1 THEN 'a.example=https://www.a.example/' || k || '|b' || k || '.example=https://b' || k || '.example/x' ELSE agency[1] || '=https://www.a.example/' || k END AS links, CAST(date AS VARCHAR) AS date,
  array_to_string(agency[:2], ', ') || CASE WHEN len(agency) > 2 THEN ' +' || (len(agency) - 2) || ' more' ELSE '' END AS outlets, date DESC_KEY FROM ev WHERE {IN_WINDOW}""".replace("date DESC_KEY", "CAST(date AS VARCHAR) || '-' || lpad(CAST(article_count AS VARCHAR), 4, '0') AS sort_key"))
def _(t):
    why = F.when(F.col("k") % 2 == 0, F.concat(F.lit(" Why "), "k", F.lit(". "))).otherwise("")
    notes = F.concat(F.lit("First "), "k", F.lit(". Then more. And the rest."))
    one = F.concat(F.lit("https://www.a.example/"), "k")
    many = F.size("agency") > 1
    urls = F.when(many, F.array(one, F.concat(F.lit("https://b"), "k", F.lit(".example/x")))).otherwise(F.array(one))
    # Where the two lists do not line up, links are labelled by host.
    outlets = F.when(many, F.array().cast("array<string>")).otherwise(F.slice("agency", 1, 1))
    rows = window_events(t).withColumn("place", F.concat_ws("-", F.col("date").cast("string"), F.lpad(F.col("article_count").cast("string"), 4, "0")))
    item = digest_item(title=state_title(F.concat(F.lit("MD — "), "activity_type"), F.col("state")), why=why, notes=notes, meta=[F.col("activity_type"), F.lit(""), F.col("actor_type")], relevance=F.col("relevance"), urls=urls, outlets=outlets, date=F.col("date"), sort_key=F.col("place"))
    out = rows.select("event_id", item.alias("i"), outlet_summary(F.col("agency"), 2).alias("outlets"))
    links = F.array_join(F.transform("i.links", lambda p: F.concat(p["label"], F.lit("="), p["url"])), "|")
    return out.select("event_id", "i.title", "i.summary", "i.meta", "i.relevance", links.alias("links"), "i.date", "outlets", "i.sort_key")


POSTAL = ["MD", "VA", "", "TX"]


@query("REP-03", with_("ev") + f""", t AS (SELECT *, CASE WHEN lane IN ('news', 'odd') THEN 'state' ELSE 'federal' END AS side, (['MD', 'VA', '', 'TX'])[1 + user_id % 4] AS st FROM ev WHERE {IN_WINDOW} AND len(competency) > 0 AND relevance >= 2),
p AS (SELECT *, row_number() OVER (PARTITION BY side, competency[1] ORDER BY relevance DESC, article_count DESC, date DESC, event_id) AS rank FROM t),
q AS (SELECT *, min(CASE WHEN side = 'state' AND relevance = 3 AND st <> '' THEN rank END) OVER (PARTITION BY competency[1]) AS must FROM p WHERE rank <= 4)
SELECT competency[1] AS category, side, CAST(rank AS INTEGER) AS rank, '- ' || CASE WHEN side = 'state' AND rank = must THEN 'MUST COVER ' ELSE '' END || '[' || CASE WHEN side = 'federal' THEN 'federal' WHEN st <> '' THEN 'state: ' || st ELSE 'state' END || '] '
  || CASE WHEN st <> '' THEN st || ': ' ELSE '' END || activity_type || ' :: Why ' || k || '. :: who: ' || actor_type AS line FROM q""")
def _(t):
    rows = window_events(t).withColumn("side", F.when(F.col("lane").isin(SIDES["state"]), "state").otherwise("federal"))
    best = ranking.top_per_category(rows, choices=COMPETENCIES, within=["side"])
    none = F.array().cast("array<string>")
    item = digest_item(title=state_title(F.col("activity_type"), fx.pick(POSTAL, F.col("user_id"))), why=F.concat(F.lit("Why "), "k", F.lit(".")), notes=F.lit(""), meta=[F.col("actor_type")], relevance=F.col("relevance"), urls=none, outlets=none, date=F.col("date"), sort_key=F.lit(""))
    return ranking.brief_lines(best.select(F.col("primary").alias("category"), "side", "rank", item.alias("item")))


@query("REP-04", with_("ev", "bills", "items", "verdicts") + """SELECT 'events' AS layer, event_id AS id, date, relevance FROM ev WHERE date >= DATE '2024-01-20' AND len(competency) > 0
UNION ALL SELECT 'bills', bill * 10 + pos, date, relevance FROM bills WHERE date >= DATE '1997-06-01' AND len(competency) > 0
UNION ALL SELECT 'hearings', o_orderkey, CAST(o_orderdate AS DATE), NULL FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-06-01' AND o_orderkey % 3 <> 0
UNION ALL SELECT 'raw', item_id, pub_date, NULL FROM items JOIN verdicts USING (item_id) WHERE pub_date >= DATE '2024-01-20' AND len(pillars) > 0""")
def _(t):
    hearings = t("orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"), F.lit(None).cast("int").alias("relevance"), fx.by_key(F.col("o_orderkey")).alias("competency"))
    raw = fx.items(t).join(fx.verdicts(t), "item_id").select(F.col("item_id").alias("id"), F.col("pub_date").alias("date"), F.lit(None).cast("int").alias("relevance"), "pillars")
    bills = fx.bills(t).withColumn("id", F.col("bill") * 10 + F.col("pos"))
    layers = {"events": (fx.events(t).withColumnRenamed("event_id", "id"), "2024-01-20", "competency"), "bills": (bills, "1997-06-01", "competency"), "hearings": (hearings, "1997-06-01", "competency"), "raw": (raw, "2024-01-20", "pillars")}
    out = None
    for name, (df, cutoff, field) in layers.items():
        part = gates.review_layer(df, cutoff=cutoff, relevant_only=True, relevance_field=field).select(F.lit(name).alias("layer"), F.col("id").cast("long").alias("id"), "date", F.col("relevance").cast("int").alias("relevance"))
        out = part if out is None else out.unionByName(part)
    return out


@query("REP-05", with_("items", "verdicts") + """, r AS (SELECT item_id, source, pillars FROM items JOIN verdicts USING (item_id)),
e AS (SELECT item_id // 2 AS event_id, unnest([item_id]) AS item_id, (['digital', 'procedure', 'incentives', 'civil-service', ''])[1 + (item_id // 2) % 5] AS competency FROM items WHERE item_id % 10 <> 9),
c AS (SELECT unnest(['civil-service', 'procedure', 'digital', 'incentives']) AS category)
SELECT source, category, count(*) FILTER (list_contains(pillars, category) AND competency = category) AS both, count(*) FILTER (list_contains(pillars, category) AND competency <> category) AS gate_only,
  count(*) FILTER (NOT list_contains(pillars, category) AND competency = category) AS classifier_only, count(*) AS n FROM r JOIN e USING (item_id), c GROUP BY 1, 2""")
def _(t):
    url = F.concat(F.lit("https://x.example/"), "item_id")
    raw = fx.items(t).join(fx.verdicts(t), "item_id").select("source", url.alias("url"), "pillars")
    # Events of two items each; every tenth item is in none.
    event = F.floor(F.col("item_id") / 2)
    named = fx.pick(["digital", "procedure", "incentives", "civil-service", ""], event)
    events = fx.items(t).where("item_id % 10 <> 9").groupBy(event.alias("event_id")).agg(F.collect_list(url).alias("source_urls"), F.array_remove(F.array(F.first(named)), "").alias("competency"))
    return aggregates.gate_and_classifier(raw, events, choices=COMPETENCIES)


@query("REP-06", with_("raw") + "SELECT count(*) AS n, count(*) FILTER (CAST(ingested_at AS DATE) - date > 7) AS late, round(avg(CASE WHEN CAST(ingested_at AS DATE) - date > 7 THEN 1.0 ELSE 0.0 END), 6) AS share FROM raw")
def _(t):
    late = F.datediff(F.to_date("ingested_at"), "date") > 7
    return fx.raw(t).agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"), F.round(F.avg(F.when(late, 1.0).otherwise(0.0)), 6).alias("share"))


WORDS = "len(list_filter(regexp_split_to_array(title, '\\s+'), lambda x: x <> ''))"


@query("REP-07", with_("items") + f"SELECT source, median({WORDS}) AS middle, max({WORDS}) AS most, round(avg(CASE WHEN {WORDS} > 15 THEN 1.0 ELSE 0.0 END), 6) AS long_share FROM items GROUP BY 1")
def _(t):
    from ..functions.text import word_count

    rows = fx.items(t).select("source", word_count(F.col("title")).cast("long").alias("w"))
    return rows.groupBy("source").agg(F.median("w").alias("middle"), F.max("w").alias("most"), F.round(F.avg(F.when(F.col("w") > 15, 1.0).otherwise(0.0)), 6).alias("long_share"))


@query("REP-08", with_("ev") + "SELECT article_count > 1 AS many, count(*) AS n, count(*) FILTER (k % 3 = 0) AS drifted FROM ev GROUP BY 1")
def _(t):
    # Two stored versions of one table; what is unchanged between them is not read again.
    old = fx.events(t).select("event_id", (F.col("article_count") > 1).alias("many"), F.col("activity_type").alias("headline"))
    spark, table = old.sparkSession, folder(old.sparkSession, "events")
    keyed.create(old, table, key="event_id", buckets=16)
    new = fx.events(t).where("k % 3 = 0").select("event_id", (F.col("article_count") > 1).alias("many"), F.lit(None).cast("string").alias("headline"))
    keyed.upsert_into(new, table, order="event_id")
    return aggregates.text_drift(keyed.read(spark, table, 1), keyed.changes(spark, table, 1, keyed.number(spark, table)), group="many", text="headline")


@query("REP-09", with_("verdicts") + ", r AS (SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM verdicts GROUP BY 1) SELECT reason, n, round(n * 100.0 / (SELECT sum(n) FROM r), 4) AS share FROM r")
def _(t):
    counts = fx.verdicts(t).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("reason", "n", F.round(F.col("n") * 100.0 / F.col("total"), 4).alias("share"))


query("REP-10", CALENDARS)(joi_09)
