"""Joins of items, clusters, events and dimensions. Spark picks broadcast by size; nothing is forced without a bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_variants, plain_words
from .shared import written

#: A word of more rows than this goes in parts where rows meet by words.
WORD_ROWS = 50_000


def drop_seen(items: DataFrame, events: DataFrame, *, url: str = "url", urls: str = "source_urls") -> DataFrame:
    """Items whose URL no event holds yet; blank URLs pass (JOI-01)."""
    seen = events.select(F.explode(urls).alias(url)).where(F.col(url) != "").distinct()
    return items.join(seen, url, "left_anti")


def members(assignments: DataFrame, rows: DataFrame, *, member: str = "member_id", row: str = "row_id") -> DataFrame:
    """Cluster members with their rows; unknown ids go (JOI-03)."""
    return assignments.join(rows, F.col(member) == F.col(row)).drop(member)


def with_singletons(assignments: DataFrame, rows: DataFrame, *, group: str) -> DataFrame:
    """Assignments plus a cluster of its own for every row that none claims (JOI-04)."""
    known = assignments.join(rows.select(F.col("row_id").alias("member_id")), "member_id", "left_semi")
    alone = rows.join(assignments.select(F.col("member_id").alias("row_id")).distinct(), "row_id", "left_anti")
    own = alone.select(F.col(group).alias("group_key"), F.concat(F.lit("row-"), F.col("row_id").cast("string")).alias("cluster_id"), F.col("row_id").alias("member_id"))
    return known.select("group_key", "cluster_id", "member_id").unionByName(own)


def match_owners(clusters: DataFrame, events: DataFrame, *, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, event_id, shared, event_date, pos) for each event that shares a URL with a cluster (JOI-05).

    ``clusters``: cluster, source_urls. A URL of two events belongs to the first stored (least ``seq``; without one, last).
    """
    owner = events.select("event_id", "date", "seq", F.explode("source_urls").alias("url")).where(F.col("url") != "")
    owner = owner.groupBy("url").agg(F.min_by(F.struct("event_id", "date"), F.struct(F.col("seq").isNull(), F.col("seq"), F.col("event_id"))).alias("o")).select("url", "o.*")
    mine = clusters.select(cluster, F.posexplode(F.array_distinct("source_urls")).alias("pos", "url"))
    return mine.join(owner, "url").groupBy(cluster, "event_id").agg(F.count(F.lit(1)).alias("shared"), F.min("date").alias("event_date"), F.min("pos").alias("pos"))


def first_known_code(df: DataFrame, codes: DataFrame, *, key: str, list_column: str) -> DataFrame:
    """The first listed code that the dimension knows; rows without one go (JOI-06). ``codes``: code, name."""
    exploded = df.select(key, F.posexplode(list_column).alias("pos", "code"))
    found = exploded.join(codes, "code").groupBy(key).agg(F.min_by("name", "pos").alias("name"))
    return df.join(found, key)


def with_roster(df: DataFrame, roster: DataFrame, *, on: list[str]) -> DataFrame:
    """Developments with roster columns where there are any (JOI-07)."""
    return df.join(roster, on, "left")


def _dealt(rows: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a ``part`` of their word, and (word, parts) of the words of more than ``WORD_ROWS`` rows.

    ``counts``: word, n. The words of many rows are few (a row for each ``WORD_ROWS`` rows at the most), so Spark sends them.
    """
    many = written(counts.select("word", F.ceil(F.col("n") / WORD_ROWS).cast("int").alias("parts")).where("parts > 1"), "frequent-words")
    own = F.xxhash64(*(c for c in rows.columns if c != "word"))
    return rows.join(many, "word", "left").withColumn("part", F.coalesce(F.pmod(own, F.col("parts").cast("long")).cast("int"), F.lit(0))).drop("parts"), many


def _to_parts(rows: DataFrame, many: DataFrame) -> DataFrame:
    """``rows`` once for each part of their word."""
    return rows.join(many, "word", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")


def match_names(articles: DataFrame, roster: DataFrame, *, key: str, text: str, candidate: str, name: str) -> DataFrame:
    """(key, candidate) of the articles that hold a form of a candidate's name as a phrase (FUN-22).

    Forms are those of ``name_variants``, of any number of words; case and punctuation do not count. A form is indexed
    by the one of its words that fewest articles hold. Each different word of an article meets the index once, and the
    forms found there are checked word by word in the article. Articles or forms without a word match nothing. A word that
    very many articles or forms hold is dealt into parts, so its rows never meet in one task.
    """
    forms = roster.select(candidate, F.explode(name_variants(F.col(name))).alias("form"))
    forms = forms.select(candidate, plain_words(F.col("form")).alias("words")).where(F.size("words") > 0).distinct()
    words = articles.select(key, plain_words(F.col(text)).alias("words"))
    said = words.select(key, F.explode(F.array_distinct("words")).alias("word"))
    counts = written(said.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    # A form with a word that no article holds is in none.
    parts = forms.select(candidate, "words", F.explode(F.array_distinct("words")).alias("word"))
    parts, many = _dealt(parts, parts.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    parts = parts.join(_to_parts(counts.select("word", F.col("n").alias("articles")), many), ["word", "part"], "left")
    index = parts.groupBy(candidate, "words").agg(F.min_by("word", F.struct("articles", "word")).alias("word"), F.bool_and(F.col("articles").isNotNull()).alias("possible"))
    index = index.where("possible").select("word", candidate, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("phrase"))
    index = written(index, "name-index")
    # Frequent words that index no form go before rows meet: a few words, as for ``_dealt``.
    idle = written(counts.where(F.col("n") > WORD_ROWS).join(index.select("word").distinct(), "word", "left_anti").select("word"), "idle-words")
    dealt, many = _dealt(said.join(idle, "word", "left_anti"), counts)
    found = dealt.join(_to_parts(index, many), ["word", "part"]).select(key, candidate, "phrase")
    lines = words.select(key, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("line"))
    return found.join(lines, key).where(F.contains("line", F.col("phrase"))).select(key, candidate).distinct()


def cross_check(a: DataFrame, b: DataFrame, *, key: str) -> DataFrame:
    """Two calendars by key: both, only a, only b, and the lead in days (JOI-09). Each has key, first_seen."""
    left, right = a.select(key, F.col("first_seen").alias("a_seen")), b.select(key, F.col("first_seen").alias("b_seen"))
    side = F.when(F.col("a_seen").isNull(), "only b").when(F.col("b_seen").isNull(), "only a").otherwise("both")
    return left.join(right, key, "full_outer").select(key, "a_seen", "b_seen", side.alias("side"), F.datediff("b_seen", "a_seen").alias("lead_days"))


def label(df: DataFrame, labels: DataFrame, *, value: str, out: str, rule: Column | None = None) -> DataFrame:
    """A display label for a value, else the value itself; a prefix rule goes first (JOI-10). ``labels``: value, label."""
    found = df.join(labels.select(F.col("value").alias(value), F.col("label").alias("label_")), value, "left")
    named = F.coalesce("label_", value)
    return found.withColumn(out, named if rule is None else F.coalesce(rule, named)).drop("label_")


def fold_keys(df: DataFrame, *, name: str, state: str) -> DataFrame:
    """Case-folded roster keys (JOI-11)."""
    return df.withColumn("name_key", F.lower(F.trim(name))).withColumn("state_key", F.upper(F.trim(state)))


def all_contained(events: DataFrame, processed: DataFrame, *, key: str = "event_id", urls: str = "source_urls") -> DataFrame:
    """Events all of whose URLs were processed; events without URLs are not (JOI-12). ``processed``: url."""
    mine = events.select(key, F.explode(urls).alias("url"))
    flagged = mine.join(processed.select("url").distinct().withColumn("hit", F.lit(True)), "url", "left")
    return flagged.groupBy(key).agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("inside")).where("inside").select(key)


def rows_by_url(events: DataFrame, rows: DataFrame, *, key: str = "event_id", urls: str = "source_urls") -> DataFrame:
    """Raw rows of the URLs that an event holds (JOI-13)."""
    return events.select(key, F.explode(F.array_distinct(urls)).alias("url")).join(rows, "url")
