"""Function queries (FUN-*): jobs over pages, documents and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import joins
from ..sources import fixtures as fx
from ..sources.fixtures import with_
from .registry import query

STRIP = "trim(regexp_replace(regexp_replace({}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("FUN-01", f"SELECT page_id, {STRIP.format('html')} AS text FROM pages")
def _(t):
    return t("pages").select("page_id", text.strip_html(F.col("html")).alias("text"))


@query("FUN-02", """WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', '', 'g'), '(?is)<style\\b.*?</style>', '', 'g') AS h FROM pages),
b AS (SELECT page_id, coalesce(nullif(regexp_extract(h, '(?is)<article\\b[^>]*>(.*?)</article>', 1), ''), h) AS s FROM a),
c AS (SELECT page_id, array_to_string(list_filter(list_transform(list_slice(regexp_split_to_array(s, '(?i)<p\\b[^>]*>'), 2, 1000000),
  lambda x: """ + STRIP.format("split_part(x, '</p>', 1)") + """), lambda x: x <> ''), ' ') AS t FROM b)
SELECT page_id, CASE WHEN length(t) >= 400 THEN substr(t, 1, 6000) END AS body FROM c""")
def _(t):
    return t("pages").select("page_id", text.article_body(F.col("html")).alias("body"))


@query("FUN-03", """WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'),
  '(?is)<style\\b.*?</style>', ' ', 'g'), '(?is)<nav\\b.*?</nav>', ' ', 'g'), '(?is)<header\\b.*?</header>', ' ', 'g'), '(?is)<footer\\b.*?</footer>', ' ', 'g'), '(?is)<form\\b.*?</form>', ' ', 'g') AS html FROM pages)
SELECT page_id, """ + STRIP.format("html") + " AS text FROM p")
def _(t):
    return t("pages").select("page_id", text.page_text(F.col("html")).alias("text"))


RESOLVED = "CASE WHEN regexp_matches({h}, '(?i)^[a-z][a-z0-9+.-]*:') THEN {h} WHEN starts_with({h}, '/') THEN root || {h} WHEN {h} = '' THEN url ELSE folder || CASE WHEN ends_with(folder, '/') THEN '' ELSE '/' END || {h} END"
BASES = """b AS (SELECT page_id, url, html, regexp_extract(url, '^([a-z][a-z0-9+.-]*://[^/?#]*)', 1) AS root,
  regexp_extract(url, '^([a-z][a-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)', 1) AS folder FROM pages)"""
ISSUES = "(?i)th|ie|ung"


@query("FUN-04", f"""WITH {BASES},
a AS (SELECT *, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href="[^"]*"[^>]*>.*?</a>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?is)<a\\b[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) AS n FROM b),
c AS (SELECT *, regexp_replace(regexp_extract(tag, '(?is)href="([^"]*)"', 1), '#.*$', '') AS h, {STRIP.format("regexp_extract(tag, '(?is)^<a[^>]*>(.*)</a>$', 1)")} AS label FROM a),
d AS (SELECT page_id, n, root, label, {RESOLVED.format(h="h")} AS link FROM c),
e AS (SELECT page_id, link, min(n) AS n FROM d WHERE starts_with(link, root) AND regexp_matches(substr(link, length(root) + 1, 1), '^[/?]?$') AND root <> ''
  AND (regexp_matches(label, '{ISSUES}') OR regexp_matches(regexp_extract(link, '^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '{ISSUES}')) GROUP BY 1, 2)
SELECT page_id, link FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n) AS r FROM e) WHERE r <= 3""")
def _(t):
    return t("pages").select("page_id", F.explode(text.issue_links(F.col("html"), F.col("url"), ISSUES, cap=3)).alias("link"))


@query("FUN-05", f"""WITH {BASES}, f AS (SELECT *, (['/feed', 'news.xml', 'https://f.example/x'])[1 + page_id % 5 % 3] AS h FROM b)
SELECT page_id, len(regexp_extract_all(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1)) AS links, len(regexp_extract_all(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1)) >= 5 AND regexp_matches(html, '(?i)<time\\b|class="[^"]*date') AS listing,
  CASE WHEN page_id % 3 < 2 THEN {RESOLVED.format(h="h")} ELSE '' END AS feeds FROM f""")
def _(t):
    kind, target = fx.pick(["rss+xml", "atom+xml", "json"], F.col("page_id")), fx.pick(["/feed", "news.xml", "https://f.example/x"], F.col("page_id") % 5)
    html = F.concat(F.lit('<head><link rel="Alternate" type="application/'), kind, F.lit('" href="'), target, F.lit('"><link rel="icon" href="/i">'), "html")
    p = t("pages").withColumn("html", html)
    return p.select("page_id", F.size(text.links(F.col("html"))).cast("long").alias("links"), text.looks_like_listing(F.col("html"), 5).alias("listing"), F.array_join(text.advertised_feeds(F.col("html"), F.col("url")), "|").alias("feeds"))


@query("FUN-06", """WITH o AS (SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 YEAR AS DATE) AS d FROM orders) SELECT id, CASE WHEN id % 6 <> 4 THEN d END AS date FROM o""")
def _(t):
    d = F.add_months(F.to_date("o_orderdate"), 120)
    kind, numbers = F.col("o_orderkey") % 6, F.date_format(d, "M/d/yyyy")
    # A shape that is no day of the calendar decides all the same; a named month of another century is no date.
    spelled = (
        F.when(kind == 0, F.concat(F.lit("on "), d.cast("string"))).when(kind == 1, F.date_format(d, "'Posted' MMMM d, yyyy")).when(kind == 2, F.date_format(d, "MM.dd.yyyy")).when(kind == 3, numbers)
        .when(kind == 4, F.concat(F.lit("2024-13-01 "), numbers)).otherwise(F.concat(F.date_format(F.add_months(d, -240), "MMMM d, yyyy "), numbers))
    )
    return t("orders").select(F.col("o_orderkey").alias("id"), dates.parse_date(spelled).alias("date"))


@query("FUN-07", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) END AS date FROM orders")
def _(t):
    url = F.concat(F.lit("https://x.example/news-"), F.when(F.col("o_orderkey") % 3 > 0, F.date_format("o_orderdate", "MMddyyyy")).otherwise("99999999"))
    return t("orders").select(F.col("o_orderkey").alias("id"), dates.slug_date(url).alias("date"))


@query("FUN-08", with_("raw") + "SELECT row_id, CASE WHEN k % 3 = 0 THEN 'M-24-' || lpad(CAST(k AS VARCHAR), 2, '0') WHEN k % 3 = 1 THEN 'M-23-' || lpad(CAST(k AS VARCHAR), 2, '0') END AS instrument FROM raw")
def _(t):
    n = F.lpad(F.col("k").cast("string"), 2, "0")
    title = F.when(F.col("k") % 3 == 0, F.concat(F.lit("Memo m-24-"), n, F.lit(" issued"))).otherwise("Memo")
    url = F.when(F.col("k") % 3 == 1, F.concat(F.lit("https://x.gov/m-23-"), n)).otherwise("https://x.gov/")
    return fx.raw(t).select("row_id", text.instrument_id(title, url).alias("instrument"))


@query("FUN-09", with_("raw") + "SELECT row_id, CASE WHEN k % 2 = 0 THEN 'Agency names ' || activity_type || ' lead' ELSE 'Whole title' END AS title FROM raw")
def _(t):
    title = F.when(F.col("k") % 2 == 0, "Agency na...").otherwise("Whole title")
    url = F.concat(F.lit("https://x.example/a/agency-names-"), "activity_type", F.lit("_lead/"))
    return fx.raw(t).select("row_id", text.slug_title(title, url).alias("title"))


@query("FUN-10", with_("raw") + "SELECT row_id, CASE WHEN k % 3 = 0 THEN CAST(ingested_at AS DATE) ELSE date END AS date FROM raw")
def _(t):
    spelled = F.when(F.col("k") % 3 == 0, F.to_date("ingested_at").cast("string")).when(F.col("k") % 3 == 1, "2024-1-1").otherwise(F.lit(None))
    return fx.raw(t).select("row_id", dates.verdict_date(spelled, F.col("date")).alias("date"))


@query("FUN-11", with_("raw") + "SELECT row_id, CASE WHEN k % 4 = 0 THEN date ELSE CAST(ingested_at AS DATE) END AS day FROM raw")
def _(t):
    return fx.raw(t).select("row_id", dates.when_ingested(F.when(F.col("k") % 4 != 0, F.col("ingested_at")), F.col("date")).alias("day"))


@query("FUN-12", with_("raw") + "SELECT row_id, CASE WHEN k % 5 = 0 THEN 0 ELSE CAST(date - DATE '1970-01-01' AS INTEGER) END AS day FROM raw")
def _(t):
    return fx.raw(t).select("row_id", dates.epoch_day(F.when(F.col("k") % 5 == 0, "2024-13-01").otherwise(F.col("date").cast("string"))).alias("day"))


@query("FUN-13", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS lines FROM documents")
def _(t):
    return t("documents").select("doc_id", F.size(text.split_list(F.col("text"))).cast("long").alias("lines"))


@query("FUN-14", """WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS s FROM documents)
SELECT doc_id, regexp_replace(array_to_string(list_slice(string_split(regexp_replace(s, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), 1, 2), ' '), '^\\s+|\\s+$', '', 'g') AS lead FROM d""")
def _(t):
    return t("documents").select("doc_id", text.first_sentences(F.col("text"), 2).alias("lead"))


#: ``#`` stands for the row's number.
BLURBS = ["Gov. Lee of Ohio signed H.R. #. It starts now.", "Ohio acts on #.", "Ohio acts; more on #. Then rest.", "They act on #. Then rest.", "Ohio acts #. " + "word " * 31 + "end.", "J. D. Vance of Ohio met # people. All left.", "The U.S. Senate passed # bills. Ohio waits! Why?", "Ohio — # acts. No. # is next."]


@query("FUN-15", with_("raw") + f""", b AS (SELECT row_id, replace(({BLURBS})[1 + k % {len(BLURBS)}], '#', CAST(k AS VARCHAR)) AS t FROM raw),
h AS (SELECT *, regexp_replace(t, '\\b((?:[A-Z]\\.)+|(?:Sen|Rep|Gov|Dept|St|No|Inc|vs)\\.)\\s+', '\\1' || chr(1), 'g') AS held FROM b),
p AS (SELECT *, list_transform(string_split(regexp_replace(held, '([.!?])\\s+', '\\1' || chr(2), 'g'), chr(2)), lambda s: len(string_split(replace(s, chr(1), ' '), ' '))) AS words FROM h)
SELECT row_id, CASE WHEN len(words) <> 2 THEN 'sentences' WHEN list_max(words) > 30 THEN 'long' WHEN contains(t, '—') OR contains(t, ';') THEN 'punctuation' WHEN NOT contains(t, 'Ohio') THEN 'state' ELSE 'none' END AS problem FROM p""")
def _(t):
    blurb = F.replace(fx.pick(BLURBS, F.col("k")), F.lit("#"), F.col("k").cast("string"))
    problem = text.blurb_problem(blurb, F.lit("Ohio"))
    return fx.raw(t).select("row_id", F.coalesce(problem, F.lit("none")).alias("problem"))


@query("FUN-16", with_("items") + "SELECT item_id, len(list_filter(regexp_split_to_array(title, '\\s+'), lambda x: x <> '')) > 30 AS over FROM items")
def _(t):
    return fx.items(t).select("item_id", text.over_word_cap(F.col("title")).alias("over"))


HOST = "coalesce(nullif(regexp_extract(url, 'https?://(?:www\\.)?([^/]+)', 1), ''), 'link')"


@query("FUN-17", f"SELECT page_id, {HOST} AS host FROM pages")
def _(t):
    return t("pages").select("page_id", text.host(F.col("url")).alias("host"))


@query("FUN-18", f"SELECT page_id, CASE WHEN {HOST.replace('(url,', chr(40) + 'replace(url, chr(46) || ' + chr(39) + 'net' + chr(39) + ', chr(46) || ' + chr(39) + 'gov' + chr(39) + '),')} LIKE '%.gov' THEN 'primary' ELSE 'press' END AS kind FROM pages")
def _(t):
    return t("pages").select("page_id", text.source_kind(F.replace(F.col("url"), F.lit(".net"), F.lit(".gov"))).alias("kind"))


@query("FUN-19", with_("raw") + "SELECT grp, string_agg(outlet || '=' || url, '|' ORDER BY s) AS links FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY s) AS n FROM (SELECT grp, url, outlet, min(seq) AS s FROM raw GROUP BY 1, 2, 3)) WHERE n <= 3 GROUP BY 1")
def _(t):
    from ..operators.aggregates import ordered_distinct

    pairs = fx.raw(t).groupBy("grp").agg(ordered_distinct("url", ["seq"]).alias("urls"), F.first("outlet").alias("outlet"))
    found = text.paired_links(F.col("urls"), F.transform("urls", lambda u: F.col("outlet")))
    return pairs.select("grp", F.array_join(F.transform(found, lambda p: F.concat(p["label"], F.lit("="), p["url"])), "|").alias("links"))


@query("FUN-20", with_("raw") + "SELECT row_id, CASE WHEN k % 2 = 0 THEN 'own.example' ELSE 'Google News' END AS labels, 1 AS n FROM raw")
def _(t):
    urls = F.when(F.col("k") % 2 == 0, F.array(F.lit("https://news.google.com/a"), F.lit("https://own.example/b"))).otherwise(F.array(F.lit("https://news.google.com/a"), F.lit("https://news.google.com/c")))
    found = text.publisher_links(urls, F.array().cast("array<string>"))
    return fx.raw(t).select("row_id", F.array_join(found["label"], "|").alias("labels"), F.size(found).alias("n"))


@query("FUN-21", with_("raw") + """, o AS (SELECT grp, lane, min(seq) AS s FROM raw GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY s) AS n, count(*) OVER (PARTITION BY grp) AS c FROM o)
SELECT grp, string_agg(lane, ', ' ORDER BY n) FILTER (n <= 2) || CASE WHEN max(c) > 2 THEN ' +' || (max(c) - 2) || ' more' ELSE '' END AS outlets FROM n GROUP BY 1""")
def _(t):
    from ..operators.aggregates import ordered_distinct

    return fx.raw(t).groupBy("grp").agg(ordered_distinct("lane", ["seq"]).alias("lanes")).select("grp", text.outlet_summary(F.col("lanes"), 2).alias("outlets"))


ARTICLES = ["Ann Lee #, again", "Now ANN B. LEE # speaks", "Annlee # is another", "Lee # and Ann", "Talk: Ann  Lee #"]


@query("FUN-22", f"""WITH a AS (SELECT o_orderkey AS article, o_custkey, replace(({ARTICLES})[1 + o_orderkey % {len(ARTICLES)}], '#', CAST(o_custkey AS VARCHAR)) AS t FROM orders),
w AS (SELECT article, ' ' || trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) || ' ' AS words FROM a),
n AS (SELECT c_custkey AS id, unnest(['ann b lee ' || c_custkey, 'ann lee ' || c_custkey]) AS form FROM customer)
SELECT DISTINCT w.article, n.id FROM a JOIN w USING (article) JOIN n ON n.id = a.o_custkey WHERE contains(w.words, ' ' || n.form || ' ')""")
def _(t):
    said = F.replace(fx.pick(ARTICLES, F.col("o_orderkey")), F.lit("#"), F.col("o_custkey").cast("string"))
    articles = t("orders").select(F.col("o_orderkey").alias("article"), said.alias("text"))
    roster = t("customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Ann  B. Lee "), "c_custkey").alias("name"))
    return joins.match_names(articles, roster, key="article", text="text", candidate="id", name="name")


NAME = ["Maria", "de", "la", "Cruz", "y", "Lopez", "B."]


@query("FUN-22-long", r"""WITH n AS (SELECT c_custkey AS id, list_concat((['Maria', 'de', 'la', 'Cruz', 'y', 'Lopez', 'B.'])[1 : c_custkey % 8], ['N' || c_custkey]) AS w FROM customer),
k AS (SELECT id, w, list_filter(w, lambda x: NOT regexp_matches(x, '^[A-Za-z]\.?$')) AS s FROM n),
f AS (SELECT id, unnest([array_to_string(w, ' '), array_to_string(s, ' '), CASE WHEN len(s) > 2 THEN s[1] || ' ' || s[-1] END]) AS form, w, s FROM k),
a AS (SELECT o_orderkey AS article, o_custkey, 'Today: ' || CASE o_orderkey % 4 WHEN 0 THEN array_to_string(w, ' ') WHEN 1 THEN upper(array_to_string(s, ' ')) WHEN 2 THEN s[1] || ' ' || s[-1] ELSE array_to_string(list_reverse(w), ' ') END || ', in state.' AS t FROM orders JOIN k ON id = o_custkey)
SELECT DISTINCT article, id FROM a JOIN f ON id = o_custkey WHERE form IS NOT NULL AND contains(' ' || trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) || ' ', ' ' || trim(regexp_replace(lower(form), '[^a-z0-9]+', ' ', 'g')) || ' ')""")
def _(t):
    """Names of one to eight words, with single letters among them, in four forms."""
    words = F.concat(F.slice(F.array(*map(F.lit, NAME)), F.lit(1), (F.col("c_custkey") % 8).cast("int")), F.array(F.concat(F.lit("N"), "c_custkey")))
    roster = t("customer").select(F.col("c_custkey").alias("id"), words.alias("w")).withColumn("name", F.array_join("w", " "))
    short = F.filter("w", lambda w: ~w.rlike(r"^[A-Za-z]\.?$"))
    k = F.col("o_orderkey") % 4
    said = F.when(k == 0, F.col("name")).when(k == 1, F.upper(F.array_join(short, " "))).when(k == 2, F.concat_ws(" ", F.element_at(short, 1), F.element_at(short, -1))).otherwise(F.array_join(F.reverse("w"), " "))
    articles = t("orders").join(roster, F.col("o_custkey") == F.col("id")).select(F.col("o_orderkey").alias("article"), F.concat(F.lit("Today: "), said, F.lit(", in state.")).alias("text"))
    return joins.match_names(articles, roster.select("id", "name"), key="article", text="text", candidate="id", name="name")


@query("FUN-24", "SELECT event_id, TRUE AS pass, CAST(user_id AS INTEGER) AS score FROM events")
def _(t):
    said = F.concat(F.lit('```json\n{"pass": true, "score": '), "user_id", F.lit('} {"pass": false}\n```'))
    v = text.verdict_json(said, "pass boolean, score int")
    return t("events").select("event_id", v["pass"].alias("pass"), v["score"].alias("score"))


@query("FUN-25", with_("raw") + "SELECT grp, substr(sha1(string_agg(url, chr(10) ORDER BY url)), 1, 16) AS event_id FROM (SELECT DISTINCT grp, url FROM raw) GROUP BY 1")
def _(t):
    return fx.raw(t).groupBy("grp").agg(F.collect_set("url").alias("urls")).select("grp", text.event_id(F.col("urls")).alias("event_id"))


@query("FUN-26", with_("ev") + "SELECT event_id, CASE WHEN k % 3 = 0 THEN state || ': Event' WHEN k % 3 = 1 THEN 'MD: Event' ELSE 'Event' END AS title FROM ev")
def _(t):
    name = F.when(F.col("k") % 3 == 1, "MD — Event").otherwise("Event")
    return fx.events(t).select("event_id", text.state_title(name, F.when(F.col("k") % 3 == 0, F.col("state")).otherwise("")).alias("title"))


@query("FUN-29", with_("raw") + "SELECT row_id, CASE WHEN k % 2 = 0 THEN 'Rule' ELSE 'payments — Rule' END AS title FROM raw")
def _(t):
    names = F.array(F.lit("GAO reports"), F.when(F.col("k") % 2 == 0, "FR term — payments").otherwise("FR term — other"))
    return fx.raw(t).select("row_id", text.strip_leaked_term(F.lit("payments — Rule"), names).alias("title"))


@query("FUN-30", "SELECT c_custkey AS id, c_custkey % 2 = 0 AS valid FROM customer")
def _(t):
    made = F.concat(fx.pick(["a", "a b", "a@", ""], F.col("c_custkey")), F.when(F.col("c_custkey") % 4 == 0, "@x.example").otherwise("x.example"))
    return t("customer").select(F.col("c_custkey").alias("id"), text.valid_email(made).alias("valid"))


@query("SRC-04", with_("items") + "SELECT item_id, 'A - ' || item_id AS title, CASE WHEN item_id % 2 = 0 THEN 'Out' ELSE source END AS outlet FROM items WHERE item_id % 2 = 0 UNION ALL SELECT item_id, 'A ' || item_id, source FROM items WHERE item_id % 2 <> 0")
def _(t):
    raw_title = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("A - "), "item_id", F.lit(" - Out"))).otherwise(F.concat(F.lit("A "), "item_id"))
    both = text.split_title_outlet(raw_title, F.col("source"))
    return fx.items(t).select("item_id", both["title"].alias("title"), both["outlet"].alias("outlet"))
