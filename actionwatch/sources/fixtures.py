"""Adapters from the star-schema tables to the event-tracking inputs, in DataFrame form and in SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
LANES = ["news", "executive-action", "oversight", "rulemaking"]
VERIFICATIONS = ["official", "reported", "announced"]
COMPETENCIES = ["civil-service", "procedure", "digital", "incentives"]
Table = Callable[[str], DataFrame]


def pick(values: list[str], n) -> object:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def by_key(n) -> object:
    """Categories of rows that have none of their own: none, one or two."""
    none = F.array().cast("array<string>")
    return F.when(n % 3 == 0, none).when(n % 3 == 1, F.array(F.lit("digital"))).otherwise(F.array(F.lit("procedure"), F.lit("incentives")))


BY_KEY = "CASE o_orderkey % 3 WHEN 0 THEN [] WHEN 1 THEN ['digital'] ELSE ['procedure', 'incentives'] END AS competency"


def raw(t: Table) -> DataFrame:
    """Raw article rows from ``events``."""
    e = t("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select(
        F.col("event_id").alias("row_id"), F.col("event_id").alias("seq"), F.col("ts").alias("ingested_at"),
        F.date_sub(F.to_date("ts"), F.col("k") % 10).alias("date"), F.col("user_id").alias("grp"), F.col("event_type").alias("activity_type"),
        F.concat(F.lit("https://o"), F.col("user_id") % 7, F.lit(".example/"), "k").alias("url"),
        F.concat(F.lit("o"), F.col("user_id") % 7).alias("outlet"), pick(LANES, F.col("k")).alias("lane"),
        pick(VERIFICATIONS, F.col("k")).alias("verification"), "k", "value",
    )


def events(t: Table) -> DataFrame:
    """Clean events from ``events``."""
    e = t("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    tag = lambda m, name: F.when(F.col("k") % m == 1, name)
    competency = F.array_compact(F.array(tag(2, "digital"), tag(3, "procedure"), tag(5, "incentives"), tag(7, "civil-service")))
    return e.select(
        "event_id", F.date_sub(F.to_date("ts"), F.col("k") % 10).alias("date"), F.nullif(F.col("k") % 4, F.lit(0)).alias("relevance"),
        (F.col("user_id") % 5 + 1).cast("int").alias("article_count"), competency.alias("competency"),
        F.concat(F.lit("S"), F.col("user_id") % 50).alias("state"), F.concat(F.lit("c"), F.col("user_id") % 120).alias("candidate"),
        F.col("event_type").alias("activity_type"), pick(["governor", "agency", "court"], F.col("user_id")).alias("actor_type"),
        F.array(F.concat(F.lit("t"), F.col("k") % 6), F.concat(F.lit("t"), F.col("k") % 10)).alias("topic_tags"),
        F.array_compact(F.array(F.when(F.col("k") % 2 == 0, "opm"), F.when(F.col("k") % 3 == 0, "omb"), F.concat(F.lit("a"), F.col("k") % 9))).alias("agency"),
        pick(LANES + ["odd"], F.col("k")).alias("lane"), pick(["executive", "legislative", "judicial"], F.col("k")).alias("branch"),
        pick(VERIFICATIONS, F.col("k")).alias("verification"), pick(["hsgac", "house-rules", "gao", "x-unknown"], F.col("k")).alias("committee"),
        pick(["senate", "house"], F.col("k")).alias("chamber"), "k", "user_id",
    )


def items(t: Table) -> DataFrame:
    """Feed items from ``documents``."""
    return t("documents").select(
        F.col("doc_id").alias("item_id"), F.col("doc_id").alias("seq"), "source", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body"),
        F.when(F.col("doc_id") % 13 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))).alias("pub_date"),
        F.col("source").isin("src0", "src1", "src2", "src3", "src4").alias("broad"), pick(LANES, F.col("doc_id")).alias("lane"),
    )


DICTIONARY = {"licence": ["license"], "vendor": ["apache", "token"]}
ANCHORS = ["data"]


def verdicts(t: Table) -> DataFrame:
    """Gate verdicts from ``labels``; unlabelled items have none."""
    pillars = F.array_compact(F.array(F.when(F.col("quality") == 1, "digital"), F.when(F.col("toxic") == 1, "procedure"), F.when(F.col("doc_id") % 4 == 0, "bogus")))
    return t("labels").select(F.col("doc_id").alias("item_id"), (F.col("quality") == 1).alias("pass"), pillars.alias("pillars"), F.when(F.col("quality") == 0, F.concat(F.lit("low quality, source group "), F.col("doc_id") % 3)).alias("reason"))


def roster(t: Table) -> DataFrame:
    """Candidates from ``customer`` and ``nation``."""
    c = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        F.concat(F.lit("c"), F.col("c_custkey") % 120).alias("short_name"), F.col("c_name").alias("candidate"), F.col("c_custkey").alias("candidate_id"), F.col("n_name").alias("state"), F.col("c_mktsegment").alias("party"),
        pick(["Toss-up", "Lean D", "Lean R", "Likely D", "Likely R", "Safe D", "Safe R"], F.col("c_custkey")).alias("race_rating"),
        pick(["nominee", "running", "incumbent", "declared", "withdrawn", "defeated", "won", "lost"], F.col("c_custkey")).alias("status"),
        pick(["open", "incumbent"], F.col("c_custkey")).alias("race_type"),
    )


def developments(t: Table) -> DataFrame:
    """Candidate developments from ``orders``."""
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.select(F.col("o_orderkey").alias("event_id"), F.col("c_name").alias("candidate"), F.col("n_name").alias("state"), F.to_date("o_orderdate").alias("date"), (F.col("o_orderkey") % 4).cast("int").alias("relevance"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("article_count"), F.col("o_orderpriority").alias("dev_type"), "o_totalprice", by_key(F.col("o_orderkey")).alias("competency"))


def bills(t: Table) -> DataFrame:
    """Bill listings by committee from ``orders`` and ``lineitem``."""
    b = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    action = F.when(F.col("l_returnflag") == "R", "reported").when(F.col("l_returnflag") == "A", "marked-up").otherwise("referred")
    return b.select(F.col("o_orderkey").alias("bill"), F.col("l_linenumber").alias("pos"), F.concat(F.lit("cmte"), F.col("l_suppkey") % 7).alias("committee"), action.alias("committee_action"), F.to_date("o_orderdate").alias("date"), F.when(F.col("l_linenumber") % 2 == 0, F.to_date("l_shipdate")).alias("committee_action_date"), (F.col("o_orderkey") % 4).cast("int").alias("relevance"), pick(["Government Operations", "Health", "", "Taxation"], F.col("o_orderkey")).alias("policy_area"), F.col("o_orderpriority").alias("topic"), by_key(F.col("o_orderkey")).alias("competency"))


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _list(values: list[str], n: str) -> str:
    return f"(['{"', '".join(values)}'])[1 + ({n}) % {len(values)}]"


#: The same adapters as common table expressions.
SQL = {
    "raw": f"""raw AS (SELECT event_id AS row_id, event_id AS seq, ts AS ingested_at, CAST(ts AS DATE) - CAST({K} % 10 AS INTEGER) AS date,
  user_id AS grp, event_type AS activity_type, 'https://o' || (user_id % 7) || '.example/' || {K} AS url, 'o' || (user_id % 7) AS outlet,
  {_list(LANES, K)} AS lane, {_list(VERIFICATIONS, K)} AS verification, {K} AS k, value FROM events)""",
    "ev": f"""ev AS (SELECT event_id, CAST(ts AS DATE) - CAST({K} % 10 AS INTEGER) AS date, nullif({K} % 4, 0) AS relevance,
  CAST(user_id % 5 + 1 AS INTEGER) AS article_count,
  list_filter([CASE WHEN {K} % 2 = 1 THEN 'digital' END, CASE WHEN {K} % 3 = 1 THEN 'procedure' END, CASE WHEN {K} % 5 = 1 THEN 'incentives' END, CASE WHEN {K} % 7 = 1 THEN 'civil-service' END], lambda x: x IS NOT NULL) AS competency,
  'S' || (user_id % 50) AS state, 'c' || (user_id % 120) AS candidate, event_type AS activity_type, {_list(["governor", "agency", "court"], "user_id")} AS actor_type,
  ['t' || ({K} % 6), 't' || ({K} % 10)] AS topic_tags,
  list_filter([CASE WHEN {K} % 2 = 0 THEN 'opm' END, CASE WHEN {K} % 3 = 0 THEN 'omb' END, 'a' || ({K} % 9)], lambda x: x IS NOT NULL) AS agency,
  {_list(LANES + ["odd"], K)} AS lane, {_list(["executive", "legislative", "judicial"], K)} AS branch, {_list(VERIFICATIONS, K)} AS verification,
  {_list(["hsgac", "house-rules", "gao", "x-unknown"], K)} AS committee, {_list(["senate", "house"], K)} AS chamber, {K} AS k, user_id FROM events)""",
    "items": f"""items AS (SELECT doc_id AS item_id, doc_id AS seq, source, split_part(text, chr(10), 1) AS title, text AS body,
  CASE WHEN doc_id % 13 <> 0 THEN DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) END AS pub_date,
  source IN ('src0', 'src1', 'src2', 'src3', 'src4') AS broad, {_list(LANES, "doc_id")} AS lane FROM documents)""",
    "verdicts": """verdicts AS (SELECT doc_id AS item_id, quality = 1 AS pass,
  list_filter([CASE WHEN quality = 1 THEN 'digital' END, CASE WHEN toxic = 1 THEN 'procedure' END, CASE WHEN doc_id % 4 = 0 THEN 'bogus' END], lambda x: x IS NOT NULL) AS pillars,
  CASE WHEN quality = 0 THEN 'low quality, source group ' || (doc_id % 3) END AS reason FROM labels)""",
    "roster": f"""roster AS (SELECT 'c' || (c_custkey % 120) AS short_name, c_name AS candidate, c_custkey AS candidate_id, n_name AS state, c_mktsegment AS party,
  {_list(["Toss-up", "Lean D", "Lean R", "Likely D", "Likely R", "Safe D", "Safe R"], "c_custkey")} AS race_rating,
  {_list(["nominee", "running", "incumbent", "declared", "withdrawn", "defeated", "won", "lost"], "c_custkey")} AS status,
  {_list(["open", "incumbent"], "c_custkey")} AS race_type FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "devs": f"""devs AS (SELECT o_orderkey AS event_id, c_name AS candidate, n_name AS state, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 4 AS INTEGER) AS relevance,
  CAST(o_orderkey % 3 + 1 AS INTEGER) AS article_count, o_orderpriority AS dev_type, o_totalprice, {BY_KEY} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "bills": f"""bills AS (SELECT o_orderkey AS bill, l_linenumber AS pos, 'cmte' || (l_suppkey % 7) AS committee,
  CASE WHEN l_returnflag = 'R' THEN 'reported' WHEN l_returnflag = 'A' THEN 'marked-up' ELSE 'referred' END AS committee_action, CAST(o_orderdate AS DATE) AS date,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS committee_action_date, CAST(o_orderkey % 4 AS INTEGER) AS relevance,
  {_list(["Government Operations", "Health", "", "Taxation"], "o_orderkey")} AS policy_area, o_orderpriority AS topic, {BY_KEY} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}


def with_(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"
