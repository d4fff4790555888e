"""Source and sink queries (SRC-*): data goes through files in the shared folder where the operator is a sink."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.shared import shared_folder
from ..sources import fixtures as fx
from ..sources import tables as op
from ..sources.fixtures import with_
from .registry import query


def _folder(df) -> str:
    return f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"


@query("SRC-01", with_("raw") + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS missing FROM raw")
def _(t):
    r = fx.raw(t)
    path = _folder(r)
    r.write.parquet(path)
    stored = op.read_table(r.sparkSession, path, r.schema)
    missing = op.read_table(r.sparkSession, path + "-none", r.schema)
    return stored.agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(missing.agg(F.count(F.lit(1)).alias("missing"))))


@query("SRC-02", with_("raw") + "SELECT DISTINCT url FROM raw")
def _(t):
    r = fx.raw(t)
    path = _folder(r)
    r.write.parquet(path)
    return op.read_table(r.sparkSession, path, r.schema, ["url"]).distinct()


@query("SRC-03", """SELECT doc_id AS item_id, nullif(substr(trim(regexp_replace(regexp_replace(split_part(text, chr(10), 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 500), '') AS title,
  nullif(substr(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 4000), '') AS body, 'https://x/' || doc_id AS url, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS pub_date FROM documents""")
def _(t):
    from ..functions.dates import parse_date

    d = t("documents").withColumn("title", F.substring_index("text", "\n", 1)).withColumn("link", F.concat(F.lit(" https://x/"), "doc_id", F.lit(" ")))
    published = parse_date(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "MMMM d, yyyy"))
    return op.normalise_items(d, title="title", body="text", url="link", published=published, extra={"item_id": F.col("doc_id")})


@query("SRC-05", with_("items") + "SELECT item_id, source, CASE WHEN source = 'src0' THEN 'wire' ELSE 'news' END AS lane FROM items")
def _(t):
    items = fx.items(t).select("item_id", "source")
    reg = op.registry(items.sparkSession, [{"source": "src0", "lane": "wire"}, {"source": "src1"}], {"source": "", "lane": "news"})
    # Two rows; a source that the registry does not list has its defaults.
    return items.join(F.broadcast(reg), "source", "left").select("item_id", "source", F.coalesce("lane", F.lit("news")).alias("lane"))


@query("SRC-06", "SELECT n_nationkey AS id, n_name AS state FROM nation")
def _(t):
    n = t("nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("state"))
    path = _folder(n)
    op.write_csv(n, path)
    return op.read_csv(n.sparkSession, path, "id long, state string")


@query("SRC-07", """SELECT CAST(o_orderkey AS VARCHAR) AS event_id, o_orderpriority AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'Hall, 12' ELSE 'Hall' END AS location,
  'W' || o_custkey || ', Chair' AS witnesses, 'https://d/' || o_orderkey || chr(10) || 'https://v/' || o_orderkey AS materials, 'hr' || o_orderkey AS bill_refs FROM orders""")
def _(t):
    j = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("event_id"), F.concat(F.lit(" "), "o_orderpriority").alias("title"),
        F.struct(F.lit("Hall").alias("building"), F.when(F.col("o_orderkey") % 2 == 0, "12").alias("room")).alias("location"),
        F.array(F.struct(F.concat(F.lit("W"), "o_custkey").alias("name"), F.lit("Chair").alias("position"), F.lit("").alias("organization"))).alias("witnesses"),
        F.array(F.struct(F.concat(F.lit("https://d/"), "o_orderkey").alias("url")), F.struct(F.concat(F.lit("https://d/"), "o_orderkey").alias("url"))).alias("documents"),
        F.array(F.struct(F.concat(F.lit("https://v/"), "o_orderkey").alias("url"))).alias("videos"),
        F.array(F.struct(F.lit("hr").alias("type"), F.col("o_orderkey").cast("string").alias("number")), F.struct(F.lit("s").alias("type"), F.lit("").alias("number"))).alias("bills"),
    ))
    return op.flatten_meetings(t("orders").select(j.alias("value")))


@query("SRC-08", """SELECT CAST(o_orderkey AS VARCHAR) AS number, o_orderpriority AS title, CASE WHEN o_orderkey % 3 > 0 THEN 'Sponsor ' || o_custkey END AS sponsor, CASE WHEN o_orderkey % 3 > 0 THEN 'I' END AS party,
  'Passed House' AS latest_action, CAST(o_orderdate AS DATE) AS date, 'passed-chamber' AS status, 'Area ' || o_orderstatus AS policy_area FROM orders""")
def _(t):
    sponsor = F.struct(F.concat(F.lit("Sponsor "), "o_custkey").alias("fullName"), F.lit("I").alias("party"))
    none = F.array().cast("array<struct<fullName:string,party:string>>")
    j = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("number"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 3 > 0, F.array(sponsor)).otherwise(none).alias("sponsors"), F.struct(F.lit("Passed House").alias("text"), F.to_date("o_orderdate").cast("string").alias("actionDate")).alias("latestAction"), F.struct(F.concat(F.lit("Area "), "o_orderstatus").alias("name")).alias("policyArea")))
    return op.flatten_bills(t("orders").select(j.alias("value")))


@query("SRC-09", """SELECT CAST(o_orderkey AS VARCHAR) AS document_number, o_orderpriority AS title, 'Abstract. Action: Notice Type: ' || o_orderstatus || ' Agencies: OPM, OMB' AS body,
  CASE WHEN o_orderkey % 3 = 0 THEN 'EO 14' WHEN o_orderkey % 3 = 1 THEN '89 FR 1' ELSE CAST(o_orderkey AS VARCHAR) END AS instrument_hint FROM orders""")
def _(t):
    k = F.col("o_orderkey") % 3
    j = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("document_number"), F.col("o_orderpriority").alias("title"), F.lit("Abstract.").alias("abstract"), F.lit("Notice").alias("action"), F.col("o_orderstatus").alias("type"), F.array(F.lit("OPM"), F.lit("OMB")).alias("agency_names"), F.array().cast("array<string>").alias("topics"), F.when(k == 1, "89 FR 1").otherwise("").alias("citation"), F.when(k == 0, "14").alias("executive_order_number")))
    return op.flatten_register(t("orders").select(j.alias("value")))


@query("SRC-10", with_("raw") + "SELECT CAST(ingested_at AS DATE) AS ingested_date, count(*) AS n FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-20' GROUP BY 1")
def _(t):
    r = fx.raw(t)
    path = _folder(r)
    op.append_raw(r.where("row_id % 2 = 0"), path)
    op.append_raw(r.where("row_id % 2 = 1"), path)
    return r.sparkSession.read.parquet(path).where("ingested_date >= date'2024-01-20'").groupBy("ingested_date").agg(F.count(F.lit(1)).alias("n"))


@query("SRC-12", "SELECT p_partkey AS part_id, p_name AS name, CAST(NULL AS VARCHAR) AS note FROM part")
def _(t):
    df = t("part").select(F.col("p_partkey").alias("PART_ID"), F.col("p_name").alias("Name"), "p_size")
    return op.reconcile(df, StructType.fromDDL("part_id bigint, name string, note string"))


@query("SRC-13", with_("ev") + "SELECT 'events' AS sheet, event_id, state, agency[1] AS url, len(competency) = 0 AS no_match, CAST(NULL AS VARCHAR) AS verdict FROM ev")
def _(t):
    return op.review_sheet(fx.events(t), sheet="events", columns=["event_id", "state"], review=["verdict"], urls="agency", category="competency")


def _rows(shape: str, table: str, key: str, given: dict[str, str]) -> str:
    """Every field of a read model as (shape, id, field, value) rows in SQL; ``given`` as in ``_models``."""
    def value(name: str, empty) -> str:
        if isinstance(empty, list):
            return f"coalesce(array_to_string({given[name]}, '|'), '')" if name in given else "''"
        blank = f"'{empty}'"
        return f"coalesce(nullif(nullif(CAST({given[name]} AS VARCHAR), '{0 if isinstance(empty, int) else ''}'), ''), {blank})" if name in given else blank

    fields = ", ".join(f"{{'field': '{n}', 'value': {value(n, e)}}}" for n, e in op.READ_MODELS[shape].items())
    return f"SELECT '{shape}' AS shape, id, unnest([{fields}], recursive := true) FROM (SELECT CAST({key} AS VARCHAR) AS id, * FROM {table})"


MODELS_SQL = with_("ev", "bills", "devs", "roster", "items") + """, hearings AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, 'Hearing ' || o_orderpriority AS title FROM orders)
""" + "\nUNION ALL ".join([
    _rows("events", "ev", "event_id", {"event_id": "event_id", "state": "state", "date": "date", "activity_type": "activity_type", "gov_actor": "actor_type", "competency": "competency", "relevance": "relevance", "topic_tags": "topic_tags", "article_count": "article_count"}),
    _rows("congress", "ev", "event_id", {"event_id": "event_id", "date": "date", "committee": "committee", "chamber": "chamber", "activity_type": "activity_type", "competency": "competency", "relevance": "relevance", "topic_tags": "topic_tags", "article_count": "article_count"}),
    _rows("hearings", "hearings", "o_orderkey", {"event_id": "o_orderkey", "title": "title", "date": "date"}),
    _rows("bills", "bills", "bill || '-' || pos", {"bill_id": "bill", "committee": "committee", "committee_action": "committee_action", "committee_action_date": "committee_action_date", "date": "date", "policy_area": "policy_area", "relevance": "relevance"}),
    _rows("federal", "ev", "event_id", {"event_id": "event_id", "date": "date", "lane": "lane", "branch": "branch", "agency": "agency", "verification": "verification", "competency": "competency", "relevance": "relevance", "topic_tags": "topic_tags", "article_count": "article_count"}),
    _rows("candidates", "roster", "candidate_id", {"name": "candidate", "state": "state", "party": "party", "status": "status", "race_type": "race_type", "race_rating": "race_rating"}),
    _rows("developments", "devs", "event_id", {"event_id": "event_id", "candidate": "candidate", "state": "state", "date": "date", "dev_type": "dev_type", "relevance": "relevance", "article_count": "article_count"}),
    _rows("state_profiles", "nation", "n_nationkey", {"state": "n_name"}),
    _rows("sources", "(SELECT DISTINCT source FROM items)", "source", {"source": "source"}),
])


@query("SRC-14", MODELS_SQL)
def _(t):
    h = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.concat(F.lit("Hearing "), "o_orderpriority").alias("title"))
    common = {c: F.col(c) for c in ("event_id", "date", "competency", "relevance", "topic_tags", "article_count")}
    mine = lambda *names: {c: F.col(c) for c in names}
    of_events = {
        "events": common | mine("state", "activity_type") | {"gov_actor": F.col("actor_type")},
        "congress": common | mine("committee", "chamber", "activity_type"),
        "federal": common | mine("lane", "branch", "agency", "verification"),
    }
    tables = [
        (fx.events(t), F.col("event_id"), of_events),
        (h, F.col("o_orderkey"), {"hearings": mine("title", "date") | {"event_id": F.col("o_orderkey")}}),
        (fx.bills(t), F.concat("bill", F.lit("-"), "pos"), {"bills": mine("committee", "committee_action", "committee_action_date", "date", "policy_area", "relevance") | {"bill_id": F.col("bill")}}),
        (fx.roster(t), F.col("candidate_id"), {"candidates": mine("state", "party", "status", "race_type", "race_rating") | {"name": F.col("candidate")}}),
        (fx.developments(t), F.col("event_id"), {"developments": mine("event_id", "candidate", "state", "date", "dev_type", "relevance", "article_count")}),
        (t("nation"), F.col("n_nationkey"), {"state_profiles": {"state": F.col("n_name")}}),
        (fx.items(t).select("source").distinct(), F.col("source"), {"sources": mine("source")}),
    ]
    return reduce(DataFrame.unionByName, (op.read_model_fields(*table) for table in tables))
