"""Funnels, facets and merged provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel(registry: DataFrame, items: DataFrame, stages: dict[str, Column], *, source: str = "source") -> DataFrame:
    """Rows of each source that reach each stage; silent sources stay with zeros (AGG-01)."""
    counts = items.groupBy(source).agg(*(F.count_if(c).alias(name) for name, c in stages.items()))
    return registry.select(source).distinct().join(counts, source, "left").fillna(0, list(stages))


def reasons(df: DataFrame, *, reason: str = "drop_reason", most: int = 60) -> DataFrame:
    """Histogram of drop reasons, cut (AGG-02)."""
    return df.where(F.col(reason).isNotNull()).groupBy(F.substring(reason, 1, most).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def intensity(df: DataFrame, *, key: str) -> DataFrame:
    """Counts by key, and 0.25 to 1.0 against the largest (AGG-03)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("most"))  # one row
    return counts.join(F.broadcast(most)).select(key, "n", F.round(0.25 + 0.75 * F.col("n") / F.col("most"), 6).alias("intensity"))


def list_facet(df: DataFrame, column: str) -> DataFrame:
    """Counts of list entries, most first (AGG-04)."""
    return df.select(F.explode(column).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value) of scalar and list columns, without blanks (AGG-05)."""
    lists = {f.name for f in df.schema if f.dataType.typeName() == "array"}

    def entries(c: str) -> Column:
        values = F.coalesce(F.col(c), F.array().cast("array<string>")) if c in lists else F.array(F.col(c))
        return F.transform(values, lambda v: F.struct(F.lit(c).alias("facet"), v.alias("value")))

    out = df.select(F.inline(F.concat(*map(entries, columns))))
    return out.where("value is not null and value <> ''").distinct()


def lead_first(df: DataFrame, column: str, lead: list[str]) -> DataFrame:
    """Facet values, the lead ones first in their order, the rest by name (AGG-06)."""
    place = F.array_position(F.array(*map(F.lit, lead)), F.col("value"))
    values = df.select(F.explode(column).alias("value")).distinct()
    return values.select("value", F.when(place > 0, place).otherwise(len(lead) + 1).alias("rank")).orderBy("rank", "value")


def known_or(column: str, choices: list[str], default: str) -> Column:
    """An unknown value falls to the default (AGG-07)."""
    return F.when(F.col(column).isin(choices), F.col(column)).otherwise(default)


def categorised_counts(layers: dict[str, DataFrame], column: str = "competency") -> DataFrame:
    """Events with a category in each layer (AGG-08). ``layers``: a table for each; for layers of one table use ``categorised_by``."""
    parts = [df.select(F.lit(name).alias("layer"), column) for name, df in layers.items()]
    return categorised_by(reduce(DataFrame.unionByName, parts), "layer", column)


def categorised_by(df: DataFrame, layer: str, column: str = "competency") -> DataFrame:
    """Events with a category by the value of ``layer``, in one scan (AGG-08)."""
    return df.groupBy(F.col(layer).alias("layer")).agg(F.count_if(F.size(column) > 0).alias("categorised"), F.count(F.lit(1)).alias("events"))


def ordered_distinct(value: str, order: list[str]) -> Column:
    """Distinct values of a group, first seen first; nulls and blanks are left out."""
    entries = F.array_sort(F.collect_list(F.when(F.coalesce(F.col(value).cast("string"), F.lit("")) != "", F.struct(*order, value))))
    return F.array_distinct(F.transform(entries, lambda e: e[value]))


def provenance(df: DataFrame, *, key: list[str], order: list[str], url: str = "url", outlet: str = "outlet", kind: str | None = None) -> DataFrame:
    """Merged sources of a cluster (AGG-09), earliest date (AGG-13) and rows; source types too, where ``kind`` is given.

    Rows are first summed up by (cluster, URL, outlet, type), so a cluster's list holds different sources only, however
    many rows repeat them.
    """
    columns = {"source_urls": url, "source_outlets": outlet} | ({"source_types": kind} if kind else {})
    pairs = df.groupBy(*dict.fromkeys([*key, *columns.values()])).agg(F.min(F.struct(*order)).alias("o"), F.count(F.lit(1)).alias("n"), F.min("date").alias("date"))
    lists = pairs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("o", *(F.col(c).alias(f"_{name}") for name, c in columns.items())))).alias("e"), F.sum("n").alias("members"), F.min("date").alias("date"))
    values = lambda c: F.array_distinct(F.filter(F.transform("e", lambda e: e[f"_{c}"]), lambda x: F.coalesce(x, F.lit("")) != ""))
    return lists.select(*key, *(values(name).alias(name) for name in columns), "members", "date")


def run_summary(clusters: DataFrame, owners: DataFrame, events: DataFrame, *, cluster: str = "cluster_id") -> DataFrame:
    """What a run did, in one row: clusters, merged ones (of several sources), new, accreted and unchanged (AGG-18).

    ``owners``: the stored event of each cluster that has one (WIN-03). A cluster whose URLs are all stored with its
    event leaves it unchanged.
    """
    known = owners.join(events.select("event_id", F.col("source_urls").alias("stored_urls")), "event_id").select(cluster, "stored_urls")
    rows = clusters.join(known, cluster, "left")
    new, grown = F.col("stored_urls").isNull(), F.size(F.array_except("source_urls", "stored_urls")) > 0
    counts = {"clusters": F.lit(True), "merged": F.size("source_urls") > 1, "new": new, "accreted": ~new & grown, "unchanged": ~new & ~grown}
    return rows.agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def gate_and_classifier(raw: DataFrame, events: DataFrame, *, choices: list[str], source: str = "source") -> DataFrame:
    """Where the gate's ``pillars`` of raw rows and the ``competency`` of the event that holds their URL differ (REP-05).

    For each source and category: rows that both name, the gate only, or the classifier only, and all rows with an event.
    A URL of several events counts with the first of these by id; rows whose URL no event holds are left out.
    """
    owner = events.select("event_id", "competency", F.explode(F.array_distinct("source_urls")).alias("url")).where(F.coalesce("url", F.lit("")) != "")
    owner = owner.groupBy("url").agg(F.min_by("competency", "event_id").alias("competency"))
    said = lambda c, v: F.coalesce(F.array_contains(c, v), F.lit(False))
    each = F.array(*(F.struct(F.lit(v).alias("category"), said("pillars", v).alias("gate"), said("competency", v).alias("classifier")) for v in choices))
    rows = raw.select(source, "url", "pillars").join(owner, "url").select(source, F.inline(each))
    gate, classifier = F.col("gate"), F.col("classifier")
    return rows.groupBy(source, "category").agg(F.count_if(gate & classifier).alias("both"), F.count_if(gate & ~classifier).alias("gate_only"), F.count_if(~gate & classifier).alias("classifier_only"), F.count(F.lit(1)).alias("n"))


def highest(value: str, ranks: list[str], default: str) -> Column:
    """The value of the highest rank in a group, ``ranks`` from low to high (AGG-10)."""
    rank = F.array_position(F.array(*map(F.lit, ranks)), F.col(value))
    return F.coalesce(F.max_by(value, F.nullif(rank, F.lit(0))), F.lit(default))


def merged_party(value: str) -> Column:
    """One party: it; several: ``member`` if among them, else ``majority``; none: ``majority`` (AGG-11)."""
    found = F.collect_set(F.when(F.col(value) != "", F.col(value)))
    return F.when(F.size(found) == 1, found[0]).when(F.array_contains(found, "member"), "member").otherwise("majority")


def first_valid(value: str, order: Column, choices: list[str]) -> Column:
    """The first valid value in member order, members without a place last (AGG-12)."""
    return F.min_by(value, F.when(F.col(value).isin(choices), F.struct(order.isNull(), order)))


def first_per_key(df: DataFrame, *, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; rows with an incomplete key go (AGG-15). Aggregates before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    complete = df.dropna(subset=keys)
    return complete.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*(x for c in order for x in (F.col(c).isNull(), F.col(c))))).alias("r")).select(*keys, "r.*")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row (AGG-20)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def text_drift(rows: DataFrame, changes: DataFrame, *, group: str, text: str) -> DataFrame:
    """Rows of each group, and of how many a text differs between two versions (REP-08).

    ``rows`` are those of the first version, ``changes`` the rows that differ (``sources.keyed.changes``).
    """
    moved = changes.where((F.col("change") == "updated") & ~F.col(f"old.{text}").eqNullSafe(F.col(f"new.{text}")))
    drifted = moved.groupBy(F.col(f"old.{group}").alias(group)).agg(F.count(F.lit(1)).alias("drifted"))
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    same = counts[group].eqNullSafe(drifted[group])
    return counts.join(drifted, same, "left").select(counts[group], "n", F.coalesce("drifted", F.lit(0)).alias("drifted"))
