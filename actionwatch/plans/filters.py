"""Filter queries (FIL-*) and set queries (SET-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lists, text
from ..operators import filters as op
from ..sources import fixtures as fx
from ..sources.fixtures import AS_OF, COMPETENCIES, with_
from .registry import query

DIGEST = ["digital", "procedure"]


def joined(c: str):
    return F.array_join(c, ",").alias(c)


@query("FIL-01", with_("items") + "SELECT item_id, pub_date FROM items WHERE pub_date >= DATE '2024-01-31' - 10")
def _(t):
    return op.date_gate(fx.items(t), date="pub_date", as_of=AS_OF, days=10).select("item_id", "pub_date")


@query("FIL-02", with_("items") + "SELECT item_id, pub_date FROM items WHERE pub_date IS NULL OR pub_date >= DATE '2024-01-31' - 10")
def _(t):
    return op.date_gate(fx.items(t), date="pub_date", as_of=AS_OF, days=10, keep_undated=True).select("item_id", "pub_date")


HITS = """list_filter([CASE WHEN regexp_matches(lower(title || ' ' || body), '(^|[^a-z0-9])(license)([^a-z0-9]|$)') THEN 'licence' END,
  CASE WHEN regexp_matches(lower(title || ' ' || body), '(^|[^a-z0-9])(apache|token)([^a-z0-9]|$)') THEN 'vendor' END], lambda x: x IS NOT NULL)"""
ANCHOR = "regexp_matches(lower(title || ' ' || body), '(^|[^a-z0-9])(data)([^a-z0-9]|$)')"


@query("FIL-03", with_("items") + f"SELECT item_id, array_to_string({HITS}, ',') AS hits FROM items WHERE len({HITS}) > 0")
def _(t):
    return op.screen(fx.items(t), texts=["title", "body"], dictionary=fx.DICTIONARY).select("item_id", joined("hits"))


@query("FIL-04", with_("items") + f"SELECT item_id, array_to_string({HITS}, ',') AS hits FROM items WHERE len({HITS}) > 0 AND NOT (broad AND NOT {ANCHOR})")
def _(t):
    return op.screen(fx.items(t), texts=["title", "body"], dictionary=fx.DICTIONARY, anchors=fx.ANCHORS, broad="broad").select("item_id", joined("hits"))


@query("FIL-05", with_("items") + f"SELECT item_id, lane, array_to_string({HITS}, ',') AS hits FROM items WHERE lane <> 'news' OR len({HITS}) > 0")
def _(t):
    return op.screen(fx.items(t), texts=["title", "body"], dictionary=fx.DICTIONARY, lane="lane", screened_lanes=["news"]).select("item_id", "lane", joined("hits"))


GATE = with_("items", "verdicts") + """, judged AS (SELECT item_id, source, pass,
  list_filter(coalesce(pillars, []), lambda x: x IN ('civil-service', 'procedure', 'digital', 'incentives')) AS valid, reason
  FROM items LEFT JOIN verdicts USING (item_id)), gated AS (SELECT item_id, source, array_to_string(valid, ',') AS pillars,
  CASE WHEN pass IS NULL THEN 'error' WHEN NOT pass THEN coalesce(nullif(reason, ''), 'rejected') WHEN len(valid) = 0 THEN 'no valid category' END AS drop_reason FROM judged)
"""


@query("FIL-06", GATE + "SELECT item_id, pillars, drop_reason, drop_reason IS NULL AS kept FROM gated")
def _(t):
    return op.verdict_gate(fx.items(t), fx.verdicts(t), key="item_id", choices=COMPETENCIES).select("item_id", joined("pillars"), "drop_reason", "kept")


@query("FIL-07", with_("items", "verdicts") + "SELECT item_id, source FROM items JOIN verdicts USING (item_id) WHERE pass")
def _(t):
    return fx.items(t).join(fx.verdicts(t), "item_id").where("pass").select("item_id", "source")


@query("FIL-08", with_("bills") + "SELECT bill, pos, policy_area FROM bills WHERE policy_area = '' OR policy_area IN ('Government Operations', 'Taxation')")
def _(t):
    return op.in_or_blank(fx.bills(t), "policy_area", ["Government Operations", "Taxation"]).select("bill", "pos", "policy_area")


@query("FIL-09", with_("roster") + "SELECT candidate, status FROM roster WHERE status NOT IN ('withdrawn', 'defeated')")
def _(t):
    return op.not_in(fx.roster(t), "status", ["withdrawn", "defeated"]).select("candidate", "status")


@query("FIL-10", with_("verdicts") + "SELECT item_id, array_to_string(list_filter(pillars, lambda x: x IN ('digital', 'procedure')), ',') AS valid FROM verdicts")
def _(t):
    return fx.verdicts(t).select("item_id", F.array_join(lists.valid_list(F.col("pillars"), DIGEST), ",").alias("valid"))


@query("FIL-11", with_("ev") + "SELECT event_id, CASE WHEN activity_type IN ('click', 'view', 'purchase') THEN activity_type ELSE 'other' END AS activity, CASE WHEN branch IN ('executive', 'judicial') THEN branch ELSE 'executive' END AS branch FROM ev")
def _(t):
    return fx.events(t).select("event_id", lists.valid_scalar(F.col("activity_type"), ["click", "view", "purchase"], "other").alias("activity"), lists.valid_scalar(F.col("branch"), ["executive", "judicial"], "executive").alias("branch"))


@query("FIL-12", with_("ev") + "SELECT event_id, CASE WHEN len(competency) > 0 AND k % 7 BETWEEN 1 AND 3 THEN CAST(k % 7 AS INTEGER) END AS relevance FROM ev")
def _(t):
    e = fx.events(t)
    spelled = F.when(F.col("k") % 7 == 6, F.lit("2.7")).otherwise(F.concat(F.lit(" "), (F.col("k") % 7).cast("string"), F.lit(" ")))
    return e.select("event_id", lists.clamp_relevance(spelled, F.col("competency")).alias("relevance"))


@query("FIL-13", with_("ev") + "SELECT event_id, date FROM ev WHERE date >= DATE '2024-01-24' AND date < DATE '2024-01-31'")
def _(t):
    return op.half_open(fx.events(t), date="date", as_of=AS_OF, days=7).select("event_id", "date")


@query("FIL-14", with_("ev") + "SELECT event_id, state FROM ev WHERE date >= DATE '2024-01-10' AND list_has_any(competency, ['digital', 'procedure']) AND list_contains(topic_tags, 't3') AND activity_type = 'click' AND actor_type = 'governor'")
def _(t):
    return op.facets(fx.events(t), since="2024-01-10", categories=DIGEST, equal={"activity_type": "click", "actor_type": "governor"}, contains={"topic_tags": "t3"}).select("event_id", "state")


@query("FIL-14-none-chosen", with_("ev") + "SELECT event_id FROM ev WHERE len(competency) > 0 AND state = 'S7'")
def _(t):
    return op.facets(fx.events(t), categories=[], empty_shows_all=True, equal={"state": "S7"}).select("event_id")


@query("FIL-15", with_("ev") + "SELECT event_id, committee FROM ev WHERE date >= DATE '2024-01-15' AND list_has_any(competency, ['incentives']) AND committee = 'gao' AND chamber = 'senate'")
def _(t):
    return op.facets(fx.events(t), since="2024-01-15", categories=["incentives"], equal={"committee": "gao", "chamber": "senate"}).select("event_id", "committee")


@query("FIL-16", with_("ev") + "SELECT event_id, branch FROM ev WHERE date >= DATE '2024-01-15' AND list_contains(agency, 'omb') AND branch = 'executive' AND verification = 'official'")
def _(t):
    return op.facets(fx.events(t), since="2024-01-15", equal={"branch": "executive", "verification": "official"}, contains={"agency": "omb"}).select("event_id", "branch")


@query("FIL-17", with_("roster", "devs") + """SELECT event_id, candidate, party FROM devs JOIN roster USING (state, candidate)
WHERE (trim(race_rating) = 'Toss-up' OR race_rating LIKE 'Lean%') AND race_type = 'open' AND party = 'MACHINERY' ORDER BY date DESC, event_id LIMIT 60""")
def _(t):
    from ..operators.ranking import competitive

    rows = fx.developments(t).join(fx.roster(t), ["state", "candidate"], "left").where(competitive(F.col("race_rating")) & (F.col("race_type") == "open") & (F.col("party") == "MACHINERY"))
    return rows.orderBy(F.desc("date"), "event_id").limit(60).select("event_id", "candidate", "party")


@query("FIL-18", with_("ev") + "SELECT event_id FROM ev WHERE state = 'S3' AND list_contains(agency, 'opm')")
def _(t):
    return op.facets(fx.events(t), equal={"state": "S3"}, contains={"agency": "opm"}).select("event_id")


@query("FIL-19", with_("bills") + """SELECT bill, pos, coalesce(committee_action_date, date) AS moved_on FROM bills
WHERE coalesce(committee_action_date, date) >= DATE '1997-01-01' - 300 AND coalesce(committee_action_date, date) < DATE '1997-01-01' AND committee_action IN ('marked-up', 'reported') AND relevance >= 2""")
def _(t):
    return op.moved_bills(fx.bills(t), as_of="1997-01-01", days=300).select("bill", "pos", "moved_on")


@query("FIL-20", with_("bills") + "SELECT bill, pos, coalesce(nullif(policy_area, ''), nullif(topic, ''), committee) AS picked FROM bills")
def _(t):
    return fx.bills(t).select("bill", "pos", text.first_filled(F.col("policy_area"), F.col("topic"), F.col("committee")).alias("picked"))


ACTIONS = ["Became Public Law No: 1", "Vetoed by President", "Passed Senate and passed House", "Agreed to in Senate", "Ordered to be Reported", "Referred to the Committee", "Introduced in House"]


@query("FIL-21", """SELECT o_orderkey AS bill, (['enacted', 'vetoed', 'passed-both', 'passed-chamber', 'reported', 'in-committee', 'introduced'])[1 + o_orderkey % 7] AS status FROM orders""")
def _(t):
    return t("orders").select(F.col("o_orderkey").alias("bill"), op.bill_status(fx.pick(ACTIONS, F.col("o_orderkey"))).alias("status"))


@query("FIL-22", """SELECT o_orderkey AS meeting, CASE WHEN o_orderkey % 4 = 0 THEN 'canceled' WHEN o_orderkey % 4 = 1 THEN 'postponed'
  WHEN o_orderkey % 4 = 2 AND CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'scheduled' ELSE 'held' END AS status FROM orders""")
def _(t):
    status = fx.pick(["Cancelled", "Postponed", " Scheduled ", ""], F.col("o_orderkey"))
    return t("orders").select(F.col("o_orderkey").alias("meeting"), op.hearing_status(status, F.to_date("o_orderdate"), "1997-01-01").alias("status"))


@query("FIL-23", "SELECT o_orderkey AS bill, (['marked-up', 'reported', 'referred', 'other'])[1 + o_orderkey % 4] AS action FROM orders")
def _(t):
    return t("orders").select(F.col("o_orderkey").alias("bill"), op.committee_action(fx.pick(["Markup by", "Reported by", "Referred to", "Discharged from"], F.col("o_orderkey"))).alias("action"))


@query("FIL-24", with_("items") + "SELECT item_id, substr(CASE WHEN title = '' THEN source ELSE source || ' — ' || title END, 1, 120) AS label FROM items")
def _(t):
    return fx.items(t).select("item_id", op.row_label(F.col("source"), F.col("title"), 120).alias("label"))


@query("FIL-25", with_("raw") + "SELECT row_id, CASE WHEN k % 3 <> 0 THEN 'https://doc.example/' || (k % 3) ELSE 'https://doc.example/x' END AS document FROM raw")
def _(t):
    candidate = F.concat(F.lit("https://doc.example/"), F.col("k") % 3)
    own = F.array("url", F.lit("https://doc.example/0"))
    return fx.raw(t).select("row_id", lists.document_url(F.array(candidate, F.lit("https://doc.example/x")), own).alias("document"))


@query("SET-01", with_("raw") + "SELECT row_id, 'news' AS origin FROM raw WHERE lane = 'news' UNION ALL SELECT row_id, 'official' FROM raw WHERE verification = 'official'")
def _(t):
    r = fx.raw(t)
    return r.where("lane = 'news'").select("row_id", F.lit("news").alias("origin")).unionByName(r.where("verification = 'official'").select("row_id", F.lit("official").alias("origin")))


@query("SET-02", with_("ev", "bills") + """SELECT 'event' AS type, CAST(event_id AS VARCHAR) AS id, committee AS title, date FROM ev
UNION ALL SELECT 'bill', bill || '-' || pos, coalesce(nullif(policy_area, ''), topic), date FROM bills""")
def _(t):
    e = fx.events(t).select(F.lit("event").alias("type"), F.col("event_id").cast("string").alias("id"), F.col("committee").alias("title"), "date")
    b = fx.bills(t).select(F.lit("bill").alias("type"), F.concat_ws("-", "bill", "pos").alias("id"), text.first_filled(F.col("policy_area"), F.col("topic")).alias("title"), "date")
    return e.unionByName(b)


@query("SET-03", with_("ev") + "SELECT event_id, array_to_string(list_concat(agency, list_filter(['opm', 'gsa'], lambda x: NOT list_contains(agency, x))), ',') AS merged FROM ev")
def _(t):
    return fx.events(t).select("event_id", F.array_join(lists.ordered_union(F.col("agency"), F.array(F.lit("opm"), F.lit("gsa"))), ",").alias("merged"))


@query("SET-04", with_("ev") + "SELECT event_id, array_to_string(list_filter(agency, lambda x: x NOT IN ('opm', 'omb')), ',') AS added FROM ev")
def _(t):
    return fx.events(t).select("event_id", F.array_join(F.array_except("agency", F.array(F.lit("opm"), F.lit("omb"))), ",").alias("added"))


@query("SET-05", with_("ev") + "SELECT event_id, CAST(len(list_filter(agency, lambda x: x IN ('opm', 'omb', 'a3'))) AS INTEGER) AS shared FROM ev")
def _(t):
    return fx.events(t).select("event_id", F.size(F.array_intersect("agency", F.array(F.lit("opm"), F.lit("omb"), F.lit("a3")))).alias("shared"))


@query("SET-06", with_("ev") + "SELECT event_id, array_to_string(CASE WHEN list_contains(agency, 'opm') THEN agency ELSE list_append(agency, 'opm') END, ',') AS agencies FROM ev")
def _(t):
    own = F.when(F.array_contains("agency", "opm"), F.col("agency")).otherwise(F.array_append("agency", F.lit("opm")))
    return fx.events(t).select("event_id", F.array_join(own, ",").alias("agencies"))


@query("SET-07", with_("raw") + """, firsts AS (SELECT url, outlet, min(seq) AS seq FROM (SELECT url, outlet, seq FROM raw UNION ALL SELECT url, lane, seq + 1000000000 FROM raw) GROUP BY url, outlet)
SELECT url, string_agg(outlet, ',' ORDER BY seq) AS merged FROM firsts GROUP BY url""")
def _(t):
    packed = fx.raw(t).select("url", "seq", F.concat_ws(" , ", "outlet", "lane").alias("packed"))
    parts = packed.select("url", "seq", F.posexplode(text.split_list(F.col("packed"), ",")).alias("pos", "part"))
    from ..operators.aggregates import ordered_distinct

    return parts.groupBy("url").agg(F.array_join(ordered_distinct("part", ["pos", "seq"]), ",").alias("merged"))
