"""Aggregation (AGG-*) and join (JOI-*) queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as op
from ..operators import joins
from ..operators.shared import shared_folder
from ..sources import fixtures as fx
from ..sources import seen
from ..sources.fixtures import COMPETENCIES, with_
from .filters import GATE, HITS
from .registry import query

@query("AGG-01", with_("items", "verdicts") + f""", reg AS (SELECT DISTINCT source FROM items UNION SELECT 'silent'),
staged AS (SELECT source, pub_date IS NULL OR pub_date >= DATE '2024-01-15' AS w, len({HITS}) > 0 AS h, coalesce(pass, FALSE) AS p, pass IS NULL AS e FROM items LEFT JOIN verdicts USING (item_id))
SELECT reg.source, count(w) AS fetched, count(*) FILTER (w) AS in_window, count(*) FILTER (w AND h) AS screened, count(*) FILTER (w AND h AND p) AS passed, count(*) FILTER (w AND h AND e) AS errors
FROM reg LEFT JOIN staged USING (source) GROUP BY 1""")
def _(t):
    from ..operators.filters import keyword_hits

    items = fx.items(t).join(fx.verdicts(t).select("item_id", "pass"), "item_id", "left")
    window = F.col("pub_date").isNull() | (F.col("pub_date") >= "2024-01-15")
    hit = F.size(keyword_hits(F.concat_ws(" ", "title", "body"), fx.DICTIONARY)) > 0
    staged = items.select("source", window.alias("w"), hit.alias("h"), F.col("pass").alias("p"))
    registry = staged.select("source").distinct().unionByName(staged.sparkSession.createDataFrame([("silent",)], "source string"))
    w, h, p = F.col("w"), F.col("h"), F.col("p")
    return op.funnel(registry, staged, {"fetched": F.lit(True), "in_window": w, "screened": w & h, "passed": w & h & F.coalesce(p, F.lit(False)), "errors": w & h & p.isNull()})


@query("AGG-02", GATE + "SELECT substr(drop_reason, 1, 60) AS reason, count(*) AS n FROM gated WHERE drop_reason IS NOT NULL GROUP BY 1")
def _(t):
    from ..operators.filters import verdict_gate

    return op.reasons(verdict_gate(fx.items(t), fx.verdicts(t), key="item_id", choices=COMPETENCIES))


@query("AGG-03", with_("ev") + ", c AS (SELECT state, count(*) AS n FROM ev GROUP BY 1) SELECT state, n, round(0.25 + 0.75 * n / (SELECT max(n) FROM c), 6) AS intensity FROM c")
def _(t):
    return op.intensity(fx.events(t), key="state")


@query("AGG-04", with_("ev") + "SELECT value, count(*) AS n FROM (SELECT unnest(topic_tags) AS value FROM ev) GROUP BY 1")
def _(t):
    return op.list_facet(fx.events(t), "topic_tags")


@query("AGG-05", with_("ev") + "SELECT DISTINCT 'activity_type' AS facet, activity_type AS value FROM ev UNION SELECT 'agency', unnest(agency) FROM ev UNION SELECT 'state', state FROM ev")
def _(t):
    return op.distinct_values(fx.events(t), ["activity_type", "agency", "state"])


@query("AGG-06", with_("ev") + "SELECT value, CASE value WHEN 'opm' THEN 1 WHEN 'omb' THEN 2 ELSE 3 END AS rank FROM (SELECT DISTINCT unnest(agency) AS value FROM ev)")
def _(t):
    return op.lead_first(fx.events(t), "agency", ["opm", "omb"])


@query("AGG-07", with_("ev") + "SELECT CASE WHEN lane IN ('news', 'executive-action', 'oversight', 'rulemaking') THEN lane ELSE 'news' END AS lane, count(*) AS n FROM ev GROUP BY 1")
def _(t):
    return fx.events(t).groupBy(op.known_or("lane", fx.LANES, "news").alias("lane")).agg(F.count(F.lit(1)).alias("n"))


@query("AGG-08", with_("ev") + "SELECT chamber AS layer, count(*) FILTER (len(competency) > 0) AS categorised, count(*) AS events FROM ev GROUP BY 1")
def _(t):
    return op.categorised_by(fx.events(t), "chamber")


@query("AGG-09", with_("raw") + """, o AS (SELECT grp, outlet, min(seq) AS s FROM raw GROUP BY 1, 2), u AS (SELECT grp, url, min(seq) AS s FROM raw GROUP BY 1, 2)
SELECT r.grp, (SELECT string_agg(url, '|' ORDER BY s) FROM u WHERE u.grp = r.grp) AS urls, (SELECT string_agg(outlet, '|' ORDER BY s) FROM o WHERE o.grp = r.grp) AS outlets,
  (SELECT string_agg(lane, '|' ORDER BY s) FROM (SELECT grp, lane, min(seq) AS s FROM raw GROUP BY 1, 2) l WHERE l.grp = r.grp) AS types, count(*) AS members FROM raw r GROUP BY r.grp""")
def _(t):
    out = op.provenance(fx.raw(t), key=["grp"], order=["seq"], kind="lane")
    return out.select("grp", F.array_join("source_urls", "|").alias("urls"), F.array_join("source_outlets", "|").alias("outlets"), F.array_join("source_types", "|").alias("types"), "members")


RANKS = ["announced", "reported", "official"]


@query("AGG-10", with_("raw") + "SELECT grp, CASE max(CASE verification WHEN 'announced' THEN 1 WHEN 'reported' THEN 2 WHEN 'official' THEN 3 END) WHEN 1 THEN 'announced' WHEN 2 THEN 'reported' WHEN 3 THEN 'official' ELSE 'reported' END AS verification FROM raw GROUP BY 1")
def _(t):
    return fx.raw(t).groupBy("grp").agg(op.highest("verification", RANKS, "reported").alias("verification"))


@query("AGG-11", with_("raw") + """, p AS (SELECT grp, nullif((['majority', 'member', '', 'minority'])[1 + k % 4], '') AS party FROM raw)
SELECT grp, CASE WHEN count(DISTINCT party) = 1 THEN min(party) WHEN bool_or(party = 'member') THEN 'member' ELSE 'majority' END AS party FROM p GROUP BY 1""")
def _(t):
    rows = fx.raw(t).withColumn("party", fx.pick(["majority", "member", "", "minority"], F.col("k")))
    return rows.groupBy("grp").agg(op.merged_party("party").alias("party"))


@query("AGG-12", with_("raw") + "SELECT grp, arg_min(lane, seq) FILTER (lane IN ('oversight', 'rulemaking')) AS lane FROM raw GROUP BY 1")
def _(t):
    return fx.raw(t).groupBy("grp").agg(op.first_valid("lane", F.col("seq"), ["oversight", "rulemaking"]).alias("lane"))


@query("AGG-13", with_("raw") + "SELECT url, min(date) AS date FROM raw GROUP BY 1")
def _(t):
    return op.provenance(fx.raw(t), key=["url"], order=["seq"]).select("url", "date")


@query("AGG-14", with_("bills") + "SELECT committee, count(*) FILTER (committee_action = 'marked-up') AS marked_up, count(*) FILTER (committee_action = 'referred') AS referred, count(*) FILTER (committee_action = 'reported') AS reported FROM bills GROUP BY 1")
def _(t):
    out = fx.bills(t).groupBy("committee").pivot("committee_action", ["marked-up", "referred", "reported"]).count().fillna(0)
    return out.withColumnRenamed("marked-up", "marked_up")


@query("AGG-15", with_("bills") + ", r AS (SELECT bill, committee, committee_action, row_number() OVER (PARTITION BY bill ORDER BY pos, committee, committee_action) AS n FROM bills) SELECT bill, committee, committee_action FROM r WHERE n = 1")
def _(t):
    return op.first_per_key(fx.bills(t).select("bill", "pos", "committee", "committee_action"), keys=["bill"], order=["pos", "committee", "committee_action"]).select("bill", "committee", "committee_action")


@query("AGG-16", with_("roster") + "SELECT state, arg_min(race_rating, candidate) AS race_rating, arg_min(race_type, candidate) AS race_type, count(*) AS candidates FROM roster WHERE status NOT IN ('withdrawn', 'defeated') GROUP BY 1")
def _(t):
    rows = fx.roster(t).where(~F.col("status").isin("withdrawn", "defeated"))
    return rows.groupBy("state").agg(F.min_by("race_rating", "candidate").alias("race_rating"), F.min_by("race_type", "candidate").alias("race_type"), F.count(F.lit(1)).alias("candidates"))


@query("AGG-17", with_("devs") + "SELECT state, candidate, count(*) AS developments, max(date) AS latest FROM devs GROUP BY 1, 2")
def _(t):
    return fx.developments(t).groupBy("state", "candidate").agg(F.count(F.lit(1)).alias("developments"), F.max("date").alias("latest"))


@query("AGG-17-totals", with_("devs") + "SELECT count(DISTINCT state) AS states, count(DISTINCT candidate) AS candidates, count(*) AS developments FROM devs")
def _(t):
    return fx.developments(t).agg(F.count_distinct("state").alias("states"), F.count_distinct("candidate").alias("candidates"), F.count(F.lit(1)).alias("developments"))


@query("AGG-18", with_("ev") + "SELECT count(*) AS events, count(*) FILTER (relevance >= 2) AS relevant, count(*) FILTER (article_count > 1) AS merged, count(*) FILTER (date >= DATE '2024-01-20') AS fresh FROM ev")
def _(t):
    return fx.events(t).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("relevance") >= 2).alias("relevant"), F.count_if(F.col("article_count") > 1).alias("merged"), F.count_if(F.col("date") >= "2024-01-20").alias("fresh"))


@query("AGG-19", "SELECT 'events' AS name, count(*) AS n FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages")
def _(t):
    names = ["events", "documents", "pages"]
    parts = [t(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("AGG-20", with_("raw") + "SELECT url, count(*) AS n FROM raw GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return op.repeated_keys(fx.raw(t), "url")


# Joins. The stored snapshot holds the rows before 2024-01-20, grouped by URL; the batch the later ones.
STORED = with_("raw") + """, stored AS (SELECT 'e' || substr(sha1(url), 1, 15) AS event_id, url, min(seq) AS seq, min(date) AS date FROM raw WHERE ingested_at < TIMESTAMP '2024-01-20' GROUP BY url),
batch AS (SELECT * FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-20')
"""


def stored(t):
    old = fx.raw(t).where("ingested_at < '2024-01-20'").groupBy("url").agg(F.min("seq").alias("seq"), F.min("date").alias("date"))
    return old.select(F.concat(F.lit("e"), F.substring(F.sha1("url"), 1, 15)).alias("event_id"), F.array("url").alias("source_urls"), "seq", "date")


def batch(t):
    return fx.raw(t).where("ingested_at >= '2024-01-20'")


@query("JOI-01", STORED + "SELECT row_id, url FROM batch WHERE url NOT IN (SELECT url FROM stored)")
def _(t):
    return joins.drop_seen(batch(t), stored(t)).select("row_id", "url")


@query("JOI-01-index", STORED + "SELECT row_id, url FROM batch WHERE url NOT IN (SELECT url FROM stored)")
def _(t):
    """The same by a stored index: two earlier batches are added, the later rows ask it."""
    index = f"{shared_folder(t('events').sparkSession)}/seen-{uuid.uuid4().hex}"
    old = fx.raw(t).where("ingested_at < '2024-01-20'")
    for part in ("ingested_at < '2024-01-10'", "ingested_at >= '2024-01-10'"):
        seen.append(old.where(part), index, parts=16)
    return seen.unseen(batch(t).select("row_id", "url"), index)


@query("JOI-02", with_("items", "verdicts") + "SELECT item_id, pass, pass IS NULL AS error FROM items LEFT JOIN verdicts USING (item_id)")
def _(t):
    return fx.items(t).join(fx.verdicts(t), "item_id", "left").select("item_id", "pass", F.col("pass").isNull().alias("error"))


ASSIGN = with_("raw") + ", asg AS (SELECT grp AS group_key, 'c' || (k % 10) || '-' || grp AS cluster_id, CASE WHEN k % 17 = 0 THEN -row_id - 1 ELSE row_id END AS member_id FROM raw WHERE k % 3 <> 0)\n"


def assignments(t):
    r = fx.raw(t).where("k % 3 <> 0")
    return r.select(F.col("grp").alias("group_key"), F.concat(F.lit("c"), F.col("k") % 10, F.lit("-"), "grp").alias("cluster_id"), F.when(F.col("k") % 17 == 0, -F.col("row_id") - 1).otherwise(F.col("row_id")).alias("member_id"))


@query("JOI-03", ASSIGN + "SELECT cluster_id, row_id, url FROM asg JOIN raw ON member_id = row_id")
def _(t):
    return joins.members(assignments(t), fx.raw(t)).select("cluster_id", "row_id", "url")


@query("JOI-04", ASSIGN + "SELECT group_key, cluster_id, member_id FROM asg WHERE member_id IN (SELECT row_id FROM raw) UNION ALL SELECT grp, 'row-' || row_id, row_id FROM raw WHERE row_id NOT IN (SELECT member_id FROM asg)")
def _(t):
    return joins.with_singletons(assignments(t), fx.raw(t), group="grp")


CLUSTERS = STORED + """, cl AS (SELECT grp AS cluster_id, url, row_number() OVER (PARTITION BY grp ORDER BY min(seq)) - 1 AS pos FROM batch GROUP BY grp, url),
matched AS (SELECT cluster_id, event_id, count(*) AS shared, min(date) AS event_date, min(pos) AS pos FROM cl JOIN stored USING (url) GROUP BY 1, 2)
"""


def clusters(t):
    return op.provenance(batch(t), key=["grp"], order=["seq"]).withColumnRenamed("grp", "cluster_id")


@query("JOI-05", CLUSTERS + "SELECT cluster_id, event_id, shared, event_date, CAST(pos AS INTEGER) AS pos FROM matched")
def _(t):
    return joins.match_owners(clusters(t), stored(t))


@query("JOI-06", with_("ev") + "SELECT event_id, CASE WHEN list_contains(agency, 'opm') THEN 'Personnel' WHEN list_contains(agency, 'omb') THEN 'Budget' ELSE 'Nine' END AS name FROM ev WHERE list_has_any(agency, ['opm', 'omb', 'a8'])")
def _(t):
    e = fx.events(t)
    codes = e.sparkSession.createDataFrame([("opm", "Personnel"), ("omb", "Budget"), ("a8", "Nine")], "code string, name string")
    return joins.first_known_code(e, codes, key="event_id", list_column="agency").select("event_id", "name")


@query("JOI-07", with_("roster", "devs") + "SELECT event_id, party, race_rating FROM devs LEFT JOIN roster USING (state, candidate)")
def _(t):
    return joins.with_roster(fx.developments(t), fx.roster(t).where("candidate is not null"), on=["state", "candidate"]).select("event_id", "party", "race_rating")


@query("JOI-08", with_("roster", "devs") + """, latest AS (SELECT state, event_id, row_number() OVER (PARTITION BY state ORDER BY date DESC, event_id) AS rn FROM devs)
SELECT n_name AS state, r.candidates, l.events FROM nation LEFT JOIN (SELECT state, count(*) AS candidates FROM roster GROUP BY 1) r ON r.state = n_name
LEFT JOIN (SELECT state, string_agg(event_id, ',' ORDER BY rn) AS events FROM latest WHERE rn <= 5 GROUP BY 1) l ON l.state = n_name""")
def _(t):
    from ..operators.ranking import top_per_group

    races = fx.roster(t).groupBy("state").agg(F.count(F.lit(1)).alias("candidates"))
    best = top_per_group(fx.developments(t), group=["state"], order=[F.desc("date"), F.asc("event_id")], cap=5)
    latest = best.groupBy("state").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "event_id"))), lambda x: x["event_id"].cast("string")), ",").alias("events"))
    return t("nation").select(F.col("n_name").alias("state")).join(races, "state", "left").join(latest, "state", "left")


CALENDARS = """WITH a AS (SELECT CAST(o_orderdate AS DATE) AS hearing_date, CAST(min(o_orderkey) AS INTEGER) AS s FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0 GROUP BY 1),
b AS (SELECT CAST(o_orderdate AS DATE) AS hearing_date, CAST(min(o_orderkey) AS INTEGER) AS s FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT hearing_date, DATE '1990-01-01' + a.s % 900 AS a_seen, DATE '1990-01-01' + b.s % 900 AS b_seen,
  CASE WHEN a.s IS NULL THEN 'only b' WHEN b.s IS NULL THEN 'only a' ELSE 'both' END AS side, CAST(b.s % 900 - a.s % 900 AS INTEGER) AS lead_days FROM a FULL JOIN b USING (hearing_date)"""


def calendar(t, status: str, step: int):
    o = t("orders").where((F.col("o_orderstatus") == status) & (F.col("o_orderkey") % step == 0))
    days = o.groupBy(F.to_date("o_orderdate").alias("hearing_date")).agg(F.min("o_orderkey").cast("int").alias("s"))
    return days.select("hearing_date", F.date_add(F.lit("1990-01-01").cast("date"), F.col("s") % 900).alias("first_seen"))


@query("JOI-09", CALENDARS)
def joi_09(t):
    return joins.cross_check(calendar(t, "F", 3), calendar(t, "O", 1), key="hearing_date")


@query("JOI-10", with_("ev") + "SELECT event_id, CASE WHEN committee LIKE 'x-%' THEN 'External' WHEN committee = 'hsgac' THEN 'Senate HSGAC' WHEN committee = 'gao' THEN 'GAO' ELSE committee END AS shown FROM ev")
def _(t):
    e = fx.events(t)
    labels = e.sparkSession.createDataFrame([("hsgac", "Senate HSGAC"), ("gao", "GAO")], "value string, label string")
    return joins.label(e, labels, value="committee", out="shown", rule=F.when(F.col("committee").startswith("x-"), "External")).select("event_id", "shown")


@query("JOI-11", with_("roster") + "SELECT candidate_id, lower(trim(candidate)) AS name_key, upper(trim(state)) AS state_key FROM roster")
def _(t):
    return joins.fold_keys(fx.roster(t), name="candidate", state="state").select("candidate_id", "name_key", "state_key")


@query("JOI-12", with_("raw") + ", done AS (SELECT DISTINCT url FROM raw WHERE k % 97 <> 0) SELECT grp FROM raw GROUP BY grp HAVING bool_and(url IN (SELECT url FROM done))")
def _(t):
    events = op.provenance(fx.raw(t), key=["grp"], order=["seq"])
    return joins.all_contained(events, fx.raw(t).where("k % 97 <> 0").select("url"), key="grp")


@query("JOI-13", STORED + "SELECT event_id, row_id FROM stored JOIN raw USING (url)")
def _(t):
    return joins.rows_by_url(stored(t), fx.raw(t).select("row_id", "url")).select("event_id", "row_id")


@query("AGG-18-run", STORED + """, c AS (SELECT grp, list(DISTINCT url) AS urls FROM batch GROUP BY 1),
m AS (SELECT b.grp, s.event_id, s.date, s.url, count(DISTINCT b.url) AS shared, min(b.seq) AS pos FROM batch b JOIN stored s USING (url) GROUP BY 1, 2, 3, 4),
o AS (SELECT grp, arg_min(url, (date, -shared, pos)) AS url FROM m GROUP BY 1)
SELECT count(*) AS clusters, count(*) FILTER (len(urls) > 1) AS merged, count(*) FILTER (o.url IS NULL) AS new,
  count(*) FILTER (o.url IS NOT NULL AND len(list_filter(urls, lambda u: u <> o.url)) > 0) AS accreted, count(*) FILTER (o.url IS NOT NULL AND len(list_filter(urls, lambda u: u <> o.url)) = 0) AS unchanged
FROM c LEFT JOIN o USING (grp)""")
def _(t):
    from ..operators.ranking import choose_owner

    mine = clusters(t)
    return op.run_summary(mine, choose_owner(joins.match_owners(mine, stored(t))), stored(t))
