"""Event lifecycle: windows, groups, event rows, upsert, accretion, pruning, merges, recipients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import ordered_union
from ..functions.text import blank_to_null, event_id, strip
from .aggregates import provenance
from .shared import written


def recent(df: DataFrame, *, as_of: str, days: int | None) -> DataFrame:
    """Rows ingested in the last ``days`` days, or all (LIF-01)."""
    return df if days is None else df.where(F.col("ingested_at") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp"))


def trigger_and_context(df: DataFrame, seen: DataFrame, *, group: str, as_of: str, trigger_days: int, context_days: int = 30, bucket: str | None = None) -> DataFrame:
    """Context rows of the groups that have an unseen URL in the trigger window (LIF-02). ``seen``: url.

    ``bucket`` names the partition column of a raw layer that is partitioned by group (``tables.append_raw``): the
    buckets of the triggered groups, at most as many as there are, become a filter on partitions of the wide window.
    """
    fresh = recent(df, as_of=as_of, days=trigger_days).join(seen.select("url"), "url", "left_anti")
    context = recent(df, as_of=as_of, days=max(trigger_days, context_days))
    if bucket is None:
        return context.join(fresh.select(group).distinct(), group, "left_semi")
    groups = written(fresh.select(group, bucket).distinct(), "triggered")
    use = [r[0] for r in groups.select(bucket).distinct().collect()]
    return context.where(F.col(bucket).isin(use)).join(groups.select(group), group, "left_semi")


def agency_group(agencies: Column, reporters: list[str]) -> Column:
    """The first agency by name that is no reporter, else the first reporter, else ``(unattributed)`` (LIF-03)."""
    own = F.array_min(F.filter(agencies, lambda a: ~a.isin(reporters)))
    return F.coalesce(own, F.array_min(agencies), F.lit("(unattributed)"))


def singleton_title(name: Column) -> Column:
    """The title after the first " — " (LIF-05)."""
    return F.regexp_replace(name, "^.*? — ", "")


def build_events(rows: DataFrame, *, key: str, distinct_ids: bool = True) -> DataFrame:
    """Event rows of clusters: merged sources, id and counts (LIF-06).

    The id is a digest of the URLs, each once (``distinct_ids``) or as often as it occurs.
    """
    merged = provenance(rows, key=[key], order=["seq"])
    if distinct_ids:
        return merged.withColumn("event_id", event_id(F.col("source_urls"))).withColumn("article_count", F.size("source_urls"))
    every = rows.groupBy(key).agg(F.collect_list("url").alias("all_urls"))
    return merged.join(every, key).withColumn("event_id", event_id(F.col("all_urls"))).withColumn("article_count", F.col("members").cast("int")).drop("all_urls")


def upsert(old: DataFrame, batch: DataFrame, *, key: str, order: str, preserve: list[str] = ()) -> DataFrame:
    """The next snapshot with a ``change`` column: created, updated or unchanged (LIF-07, SRC-11).

    Blank keys of the batch are skipped; of rows with one key the last by ``order`` counts, a row without an order only
    where no other is. A non-empty ``preserve``
    column of the stored row wins. Stored rows that the batch does not name stay.
    """
    columns = [c for c in old.columns if c != key]
    rows = batch.where(blank_to_null(F.col(key).cast("string")).isNotNull())
    rows = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(F.col(order))).alias("new"))
    both = old.select(key, F.struct(*columns).alias("old")).join(rows, key, "full_outer")

    def value(c: str) -> Column:
        taken = F.when(F.col("new").isNull(), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}"))
        if c in preserve:
            kept = F.col(f"old.{c}")
            return F.when(blank_to_null(kept.cast("string")).isNotNull(), kept).otherwise(taken)
        return taken

    out = both.select(key, F.struct(*(value(c).alias(c) for c in columns)).alias("now"), "old")
    change = F.when(F.col("old").isNull(), "created").when(F.col("old").eqNullSafe(F.col("now")), "unchanged").otherwise("updated")
    return out.select(key, "now.*", change.alias("change"))


def accrete(events: DataFrame, additions: DataFrame, *, key: str = "event_id", regenerated: list[str] = ()) -> DataFrame:
    """First writer wins: sources grow, all other columns stay (LIF-08); ``regenerated`` columns are taken anew (LIF-09).

    ``additions``: key, source_urls, source_outlets, source_types where both tables have them and, where regenerated,
    those columns. Rows of one key are one addition: their lists follow one another, and the largest of their
    regenerated values counts.
    """
    grown = [c for c in ("source_urls", "source_outlets", "source_types") if c in events.columns and c in additions.columns]
    lists = F.array_sort(F.collect_list(F.struct(*grown)))
    additions = additions.groupBy(key).agg(lists.alias("rows"), F.max(F.struct(F.lit(True), *regenerated)).alias("made"))
    together = lambda c: F.flatten(F.transform("rows", lambda r: F.coalesce(r[c], F.array().cast("array<string>")))).alias(f"add_{c}")
    add = additions.select(key, *map(together, grown), *(F.col("made")[c].alias(f"add_{c}") for c in regenerated), F.lit(True).alias("touched"))
    both = events.join(add, key, "left")
    fresh = F.size(F.array_except(F.coalesce("add_source_urls", F.array().cast("array<string>")), "source_urls"))
    both = both.withColumn("new_urls", fresh).withColumns({c: ordered_union(F.col(c), F.col(f"add_{c}")) for c in grown})
    return both.withColumns({c: F.when(F.col("touched"), F.col(f"add_{c}")).otherwise(F.col(c)) for c in regenerated}).select(*events.columns, "new_urls")


def prune(events: DataFrame, produced: DataFrame, contained: DataFrame, *, key: str = "event_id", review: str = "review_status") -> DataFrame:
    """Superseded events: not produced now, all inputs processed; ``delete`` if unreviewed, else ``report`` (LIF-11)."""
    old = events.join(produced.select(key), key, "left_anti").join(contained.select(key), key, "left_semi")
    reviewed = ~F.coalesce(blank_to_null(F.col(review)), F.lit("unreviewed")).isin("unreviewed")
    return old.withColumn("action", F.when(reviewed, "report").otherwise("delete"))


def rebuild_floor(rows: DataFrame, *, as_of: str, days: int):
    """First day of a rebuild: the window's, or an earlier date among freshly ingested rows (LIF-12). One value."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    fresh = rows.where(F.to_date("ingested_at") >= start)
    return fresh.agg(F.least(F.coalesce(F.min("date"), start), start).alias("floor"))


def rebuild(clean: DataFrame, rebuilt: DataFrame, floor: DataFrame) -> DataFrame:
    """Clean rows before the floor and undated ones stay; from it on the rebuilt ones stand (LIF-12)."""
    old = clean.join(F.broadcast(floor)).where(F.col("date").isNull() | (F.col("date") < F.col("floor"))).drop("floor")
    new = rebuilt.join(F.broadcast(floor)).where(F.col("date") >= F.col("floor")).drop("floor")
    return old.unionByName(new)


def human_merge(events: DataFrame, groups: DataFrame, *, key: str = "event_id") -> DataFrame:
    """One survivor a group: earliest date, then most sources; it takes over all sources and missing reviews (LIF-13).

    ``groups``: group_no, key. Returns one row a group with its members' number; groups of one known event are bad.
    """
    rows = groups.join(events, key)
    order = F.struct(F.col("date").isNull(), F.col("date"), -F.size("source_urls"), F.col(key))
    entries = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("source_urls"))))
    reviews = F.array_sort(F.collect_list(F.when(blank_to_null(F.col("review_status")).isNotNull(), F.struct(order.alias("o"), F.col("review_status")))))
    return rows.groupBy("group_no").agg(
        F.min_by(key, order).alias("survivor"), F.array_distinct(F.flatten(F.transform(entries, lambda e: e["source_urls"]))).alias("source_urls"),
        F.get(reviews, F.lit(0))["review_status"].alias("review_status"), F.count(F.lit(1)).alias("members"),
    ).withColumn("bad", F.col("members") < 2)


def never_downgrade(old: Column, new: Column) -> Column:
    """An empty re-classification keeps the stored list (LIF-14)."""
    return F.when(F.size(F.coalesce(new, F.array().cast("array<string>"))) == 0, old).otherwise(new)


def backfill_ingested(ingested: Column, created: Column, date: Column) -> Column:
    """(LIF-15)"""
    return F.coalesce(ingested, created, date.cast("timestamp"))


def backfill_id(current: Column, urls: Column) -> Column:
    """A digest id where there is no 16-hex one (LIF-16)."""
    return F.when(F.coalesce(current, F.lit("")).rlike("^[0-9a-f]{16}$"), current).otherwise(event_id(urls))


#: Fixed value: length to which a verdict's short title is cut.
SHORT_TITLE = 160


def apply_verdict(rows: DataFrame, verdicts: DataFrame, *, key: str, choices: list[str], tags: list[str] | None = None, summary: str = "summary") -> DataFrame:
    """What a verdict says of a row (LIF-18); rows without a verdict stay as they are.

    Verdicts: key, competencies, relevance and, where they have them, summary, short_title, why_it_matters, topic_tags.
    Categories, relevance, tags (valid ones only, where ``tags`` is given) and why it matters are replaced; a summary and a
    short title only where the verdict has one. Columns that either side lacks are left alone; ``summary`` names the
    row's column. Of several verdicts of one key the greatest by its columns counts.
    """
    from ..functions.lists import clamp_relevance, valid_list

    names = {"summary": summary, "short_title": "short_title", "why_it_matters": "why_it_matters", "topic_tags": "topic_tags"}
    more = [c for c in names if c in verdicts.columns and names[c] in rows.columns]
    v = verdicts.groupBy(key).agg(F.max(F.struct("competencies", "relevance", *more)).alias("verdict"))
    both = rows.join(v, key, "left")
    judged, said = F.col("verdict").isNotNull(), lambda c: F.col(f"verdict.{c}")
    categories = valid_list(said("competencies"), choices)
    new = {"competency": categories, "relevance": clamp_relevance(said("relevance"), categories)}
    if "summary" in more:
        new[summary] = F.coalesce(F.nullif(said("summary"), F.lit("")), F.col(summary), F.lit(""))
    if "short_title" in more:
        new["short_title"] = F.coalesce(F.substring(F.nullif(said("short_title"), F.lit("")), 1, SHORT_TITLE), F.col("short_title"))
    if "why_it_matters" in more:
        new["why_it_matters"] = F.coalesce(said("why_it_matters"), F.lit(""))
    if "topic_tags" in more:
        new["topic_tags"] = F.coalesce(said("topic_tags"), F.array().cast("array<string>")) if tags is None else valid_list(said("topic_tags"), tags)
    return both.withColumns({c: F.when(judged, value).otherwise(F.col(c)) for c, value in new.items()}).drop("verdict")


def seed_roster(old: DataFrame, seed: DataFrame, *, keys: list[str], owned: list[str]) -> DataFrame:
    """Seed-owned columns are overwritten where the seed has a value; all others stay; new candidates join (LIF-19).

    Columns keep their types; a seed value of another type is cast, and is no value where it cannot be. Of several seed
    rows for one candidate the greatest value of each column counts, so a candidate stays one row.
    """
    filled = lambda c: F.when(blank_to_null(strip(F.col(c).cast("string"))).isNotNull(), F.col(c))
    new = seed.groupBy(*keys).agg(*(F.max(filled(c)).alias(f"seed_{c}") for c in owned))
    both = old.join(new, keys, "full_outer")
    kinds = dict(old.dtypes)

    def value(c: str) -> Column:
        given = F.when(blank_to_null(strip(F.col(f"seed_{c}").cast("string"))).isNotNull(), F.col(f"seed_{c}").try_cast(kinds[c]))
        return F.coalesce(given, F.col(c)) if c in owned else F.col(c)

    return both.select(*keys, *(value(c).alias(c) for c in old.columns if c not in keys))


def subscribe(recipients: DataFrame, signups: DataFrame) -> DataFrame:
    """Recipients after a batch of sign-ups: new ones are active, unsubscribed ones come back (LIF-20).

    Recipients: email (lower case), status, unsubscribed_at. Sign-ups: email, ts; invalid addresses are dropped.
    """
    from ..functions.text import valid_email

    wanted = signups.select(F.lower(F.trim("email")).alias("email")).where(valid_email(F.col("email"))).distinct().withColumn("wanted", F.lit(True))
    both = recipients.join(wanted, "email", "full_outer")
    back = F.coalesce("wanted", F.lit(False))
    action = F.when(~back, "none").when(F.col("status").isNull(), "created").when(F.col("status") == "active", "none").otherwise("reactivated")
    return both.select("email", F.when(back, "active").otherwise(F.col("status")).alias("status"), F.when(~back, F.col("unsubscribed_at")).alias("unsubscribed_at"), action.alias("action"))


def malformed_recipients(recipients: DataFrame) -> DataFrame:
    """The number of active rows whose address is no address, in one row (LIF-21)."""
    from ..functions.text import valid_email

    wrong = (F.col("status") == "active") & ~F.coalesce(valid_email(F.trim("email")), F.lit(False))
    return recipients.agg(F.count_if(wrong).alias("malformed"))


def active_recipients(recipients: DataFrame, *, seq: str = "seq") -> DataFrame:
    """Valid, active addresses, the first row of each in lower case (LIF-21)."""
    from ..functions.text import valid_email

    rows = recipients.where((F.col("status") == "active") & valid_email(F.trim("email"))).withColumn("address", F.lower(F.trim("email")))
    return rows.groupBy("address").agg(F.min(seq).alias(seq))
