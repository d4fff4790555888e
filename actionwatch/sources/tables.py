"""Reading, reconciling and writing the tables of the tracker."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import versions

#: Lengths to which feed fields are cut.
TITLE, EXCERPT, BODY = 500, 1500, 4000


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None) -> DataFrame:
    """A table, pruned to ``columns`` in the scan; a missing one reads as empty (SRC-01, SRC-02)."""
    df = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return df.select(columns) if columns else df


def normalise_items(df: DataFrame, *, title: str, body: str, url: str, published: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """Landed feed items in one schema: tags stripped, white space trimmed, lengths cut, dates parsed (SRC-03)."""
    from ..functions.text import blank_to_null, strip_html

    clean = lambda c, n: blank_to_null(F.substring(F.trim(strip_html(F.col(c))), 1, n))
    return df.select(*(c.alias(n) for n, c in (extra or {}).items()), clean(title, TITLE).alias("title"), clean(body, BODY).alias("body"), F.trim(url).alias("url"), published.alias("pub_date"))


def registry(spark: SparkSession, rows: list[dict], defaults: dict[str, str]) -> DataFrame:
    """The dimension of sources, with a default for each missing column (SRC-05)."""
    columns = list(defaults)
    return spark.createDataFrame([tuple((r.get(c) or defaults[c]) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))


def write_csv(df: DataFrame, path: str) -> None:
    """(SRC-06)"""
    df.write.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(SRC-06)"""
    return spark.read.schema(schema).option("header", True).csv(path)


MEETING = """event_id string, title string, location struct<building:string,room:string>, witnesses array<struct<name:string,position:string,organization:string>>,
  documents array<struct<url:string>>, videos array<struct<url:string>>, bills array<struct<type:string,number:string>>"""


def flatten_meetings(json: DataFrame, column: str = "value", schema: str = MEETING) -> DataFrame:
    """Witness lines, material links, bill references and place of meeting records (SRC-07)."""
    m = json.select(F.from_json(column, schema).alias("m")).select("m.*")
    filled = lambda *c: F.array_join(F.array_compact(F.array(*(F.nullif(x, F.lit("")) for x in c))), ", ")
    witnesses = F.array_distinct(F.filter(F.transform(F.coalesce("witnesses", F.array().cast("array<struct<name:string,position:string,organization:string>>")), lambda w: filled(w["name"], w["position"], w["organization"])), lambda x: x != ""))
    urls = F.array_distinct(F.filter(F.concat(F.coalesce("documents.url", F.array().cast("array<string>")), F.coalesce("videos.url", F.array().cast("array<string>"))), lambda u: u.isNotNull() & (u != "")))
    bills = F.transform(F.filter("bills", lambda b: F.coalesce(b["number"], F.lit("")) != ""), lambda b: F.concat(F.coalesce(b["type"], F.lit("")), b["number"]))
    return m.select("event_id", F.trim("title").alias("title"), filled(F.col("location.building"), F.col("location.room")).alias("location"), F.array_join(witnesses, "\n").alias("witnesses"), F.array_join(urls, "\n").alias("materials"), F.coalesce(F.array_join(bills, ", "), F.lit("")).alias("bill_refs"))


BILL = "number string, title string, sponsors array<struct<fullName:string,party:string>>, latestAction struct<text:string,actionDate:string>, policyArea struct<name:string>"


def flatten_bills(json: DataFrame, column: str = "value", schema: str = BILL) -> DataFrame:
    """First sponsor, latest action and status of bill records (SRC-08)."""
    from ..operators.filters import bill_status

    b = json.select(F.from_json(column, schema).alias("b")).select("b.*")
    sponsor = F.get("sponsors", F.lit(0))
    return b.select("number", "title", sponsor["fullName"].alias("sponsor"), sponsor["party"].alias("party"), F.col("latestAction.text").alias("latest_action"), F.try_to_date(F.col("latestAction.actionDate"), "yyyy-MM-dd").alias("date"), bill_status(F.col("latestAction.text")).alias("status"), F.col("policyArea.name").alias("policy_area"))


REGISTER = "document_number string, title string, abstract string, action string, type string, agency_names array<string>, topics array<string>, docket_ids array<string>, citation string, executive_order_number string"


def flatten_register(json: DataFrame, column: str = "value", schema: str = REGISTER) -> DataFrame:
    """Labelled body and instrument hint of register documents (SRC-09)."""
    r = json.select(F.from_json(column, schema).alias("r")).select("r.*")
    part = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c))
    body = F.concat_ws(" ", F.nullif("abstract", F.lit("")), part("Action", F.col("action")), part("Type", F.col("type")), part("Agencies", F.array_join("agency_names", ", ")), part("Topics", F.array_join("topics", ", ")), part("Docket", F.array_join("docket_ids", ", ")))
    hint = F.coalesce(F.concat(F.lit("EO "), F.nullif("executive_order_number", F.lit(""))), F.nullif("citation", F.lit("")), "document_number")
    return r.select("document_number", "title", body.alias("body"), hint.alias("instrument_hint"))


def append_raw(df: DataFrame, path: str, *, group: str | None = None, buckets: int = 64) -> None:
    """The append-only raw layer, partitioned by day of ingestion (SRC-10), and by a hash of ``group`` before it.

    With groups, the context of a few of them over many days is a few partitions (``lifecycle.trigger_and_context``).
    """
    rows = df.withColumn("ingested_date", F.to_date("ingested_at"))
    parts = ["ingested_date"]
    if group is not None:
        rows = rows.withColumn("group_bucket", F.pmod(F.xxhash64(F.col(group).cast("string")), F.lit(buckets)).cast("int"))
        parts = ["group_bucket", *parts]
    rows.write.mode("append").partitionBy(*parts).parquet(path)


def snapshot_number(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 where there is none."""
    return versions.numbers(spark, f"{path}/_current")[0]


def write_snapshot(df: DataFrame, path: str, after: int | None = None) -> str:
    """A new version of a table in a folder of its own; a numbered pointer comes last, so readers see all or nothing.

    Spark cannot overwrite what it is reading; a version folder needs no overwrite, and neither does a pointer: readers
    take the one of the highest number. ``after`` is the number of the version that ``df`` was made from.
    Where another writer has taken the next number, this one raises and changes nothing; a number that a dead writer has
    left empty is passed over. Tables that change in parts are better kept by ``keyed``.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    last, taken = versions.numbers(spark, f"{path}/_current")
    if after is not None and last != after:
        raise RuntimeError(f"version {after + 1} of {path} was written by another writer")
    versions.publish(spark, f"{path}/_current", max(last, taken) + 1, version)
    return version


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest version."""
    number = snapshot_number(spark, path)
    if not number:
        raise FileNotFoundError(f"{path} has no version")
    return spark.read.parquet(f"{path}/{spark.read.text(f'{path}/_current/{number:012d}').first()[0]}")


def reconcile(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns only: matched without regard to case, missing ones null, others dropped (SRC-12)."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*((F.col(f"`{have[f.name.lower()]}`").cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def review_sheet(df: DataFrame, *, sheet: str, columns: list[str], review: list[str], urls: str, category: str) -> DataFrame:
    """Rows for review: declared columns, the first URL, empty review columns, a flag for rows without a category (SRC-13)."""
    return df.select(F.lit(sheet).alias("sheet"), *columns, F.get(urls, F.lit(0)).alias("url"), (F.size(category) == 0).alias("no_match"), *(F.lit(None).cast("string").alias(c) for c in review))


def write_review(df: DataFrame, path: str) -> None:
    """One folder a sheet (SRC-13)."""
    df.write.partitionBy("sheet").option("header", True).csv(path)


def project(df: DataFrame, shape: dict[str, Column | str | int]) -> DataFrame:
    """A read-model row: each name from a column, null replaced by the type's empty value (SRC-14)."""
    empty = {"string": F.lit(""), "int": F.lit(0), "bigint": F.lit(0).cast("long"), "array<string>": F.array().cast("array<string>")}
    kinds = dict(df.dtypes)
    return df.select(*((F.coalesce(F.col(c), empty[kinds[c]]) if isinstance(c, str) and kinds.get(c) in empty else F.col(c) if isinstance(c, str) else c).alias(n) for n, c in shape.items()))


#: Names and empty values of the read models' rows.
READ_MODELS = {
    "events": {"event_id": "", "name": "", "state": "", "date": "", "activity_type": "", "gov_actor": "", "competency": [], "relevance": 0, "topic_tags": [], "article_count": 1, "review_status": "unreviewed", "urls": [], "outlets": []},
    "congress": {"event_id": "", "short_title": "", "headline": "", "summary": "", "why_it_matters": "", "date": "", "committee": "", "chamber": "", "party_source": "", "activity_type": "", "competency": [], "relevance": 0, "topic_tags": [], "actor": "", "bill_refs": "", "status": "", "article_count": 1, "review_status": "unreviewed", "urls": [], "outlets": []},
    "hearings": {"event_id": "", "title": "", "committee": "", "chamber": "", "date": "", "location": "", "status": "", "witnesses": [], "bill_refs": "", "competency": [], "relevance": 0},
    "bills": {"bill_id": "", "title": "", "committee": "", "committee_action": "", "committee_action_date": "", "date": "", "policy_area": "", "sponsor": "", "status": "", "competency": [], "relevance": 0},
    "federal": {"event_id": "", "short_title": "", "headline": "", "summary": "", "why_it_matters": "", "date": "", "lane": "news", "branch": "executive", "agency": [], "instrument_type": "", "instrument_id": "", "verification": "", "competency": [], "relevance": 0, "topic_tags": [], "actor": "", "status": "", "document_url": "", "article_count": 1, "review_status": "unreviewed", "urls": [], "outlets": []},
    "candidates": {"name": "", "state": "", "party": "", "status": "", "role": "", "race_type": "", "race_rating": "", "primary_date": "", "website": "", "platform_summary": "", "competency_signals": [], "platform_sources": [], "platform_asof": "", "notes": ""},
    "developments": {"event_id": "", "candidate": "", "state": "", "headline": "", "summary": "", "date": "", "dev_type": "", "relevance": 0, "article_count": 1, "urls": [], "outlets": []},
    "state_profiles": {"state": "", "governor": "", "party": "", "legislature": "", "notes": "", "sources": []},
    "sources": {"source": "", "lane": "news", "kind": "", "url": "", "status": ""},
}


def _model_value(given: Column | None, empty) -> Column:
    """``given``, or the name's empty value where it is missing, null or empty; a number 0 counts as missing, as in FIL-20."""
    if isinstance(empty, list):
        none = F.array().cast("array<string>")
        return none if given is None else F.coalesce(given.cast("array<string>"), none)
    kind = "long" if isinstance(empty, int) else "string"
    return F.lit(empty).cast(kind) if given is None else F.coalesce(F.nullif(given.cast(kind), F.lit(0 if kind == "long" else "").cast(kind)), F.lit(empty).cast(kind))


def read_model(df: DataFrame, shape: str, key: Column, given: dict[str, Column]) -> DataFrame:
    """Rows of a read model (SRC-14): ``id`` and every name of the shape, from ``given`` or empty."""
    return df.select(key.cast("string").alias("id"), *(_model_value(given.get(n), e).alias(n) for n, e in READ_MODELS[shape].items()))


def read_model_fields(df: DataFrame, key: Column, models: dict[str, dict[str, Column]]) -> DataFrame:
    """Every field of the rows of one or more read models as (shape, id, field, value); ``models`` has ``given`` by shape (SRC-14).

    Models of one table share a reading of it, and a value that several have is made once a row. Lists are joined by ``|``.
    """
    made, cells = {}, []
    for shape, given in models.items():
        for name, empty in READ_MODELS[shape].items():
            value = _model_value(given.get(name), empty)
            text = F.array_join(value, "|") if isinstance(empty, list) else value.cast("string")
            if name in given:
                # By its expression: two models may fill one name from different columns or with different empty values.
                alias = made.setdefault(str(text), (f"v{len(made)}", text))[0]
                text = F.col(alias)
            elif isinstance(empty, list):
                text = F.lit("")
            cells.append(F.struct(F.lit(shape).alias("shape"), F.lit(name).alias("field"), text.alias("value")))
    rows = df.select(key.cast("string").alias("id"), *(text.alias(alias) for alias, text in made.values()))
    return rows.select("id", F.inline(F.array(*cells))).select("shape", "id", "field", "value")
