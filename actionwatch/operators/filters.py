"""Gates, screens, verdicts and facet filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import valid_list
from ..functions.text import blank_to_null


def date_gate(df: DataFrame, *, date: str, as_of: str, days: int, keep_undated: bool = False) -> DataFrame:
    """Rows of the last ``days`` days; undated rows are dropped (FIL-01) or kept (FIL-02)."""
    recent = F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(date).isNull() | recent if keep_undated else recent)


def dictionary_pattern(words: list[str], bounded: bool = True) -> str:
    """One constant pattern for a dictionary; bounded by ASCII word characters or found anywhere. Terms are regular expressions."""
    any_ = "|".join(sorted(words))
    return rf"(^|[^a-z0-9])({any_})([^a-z0-9]|$)" if bounded else f"({any_})"


def keyword_hits(text: Column, dictionary: dict[str, list[str]], bounded: bool = True) -> Column:
    """Names of the dictionaries that occur in the text, in dictionary order (FIL-03)."""
    low = F.lower(text)
    return F.array_compact(F.array(*(F.when(low.rlike(dictionary_pattern(words, bounded)), F.lit(name)) for name, words in dictionary.items())))


def screen(df: DataFrame, *, texts: list[str], dictionary: dict[str, list[str]], anchors: list[str] | None = None, broad: str | None = None, lane: str | None = None, screened_lanes: list[str] | None = None, hits: str = "hits") -> DataFrame:
    """Keep rows with a dictionary hit (FIL-03).

    Rows marked ``broad`` must hit an anchor as well (FIL-04). With ``lane``, only the named lanes are screened and
    all others pass (FIL-05).
    """
    text = F.concat_ws(" ", *texts)
    found = keyword_hits(text, dictionary)
    if anchors is not None and broad is not None:
        anchored = F.lower(text).rlike(dictionary_pattern(anchors))
        found = F.when(F.col(broad) & ~anchored, F.array().cast("array<string>")).otherwise(found)
    out = df.withColumn(hits, found)
    keep = F.size(hits) > 0
    if lane is not None:
        keep = ~F.col(lane).isin(screened_lanes or []) | keep
    return out.where(keep)


def verdict_gate(items: DataFrame, verdicts: DataFrame, *, key: str, choices: list[str]) -> DataFrame:
    """Items with their verdict's outcome: ``kept``, the valid ``pillars`` and a ``drop_reason`` (FIL-06, JOI-02).

    An item without a verdict is an error row, not a rejection. Of several verdicts for one item, one that passes counts
    before one that does not, then the greatest by pillars and reason, so an item stays one row.
    """
    given = verdicts.select(key, F.struct(F.col("pass").alias("passed"), "pillars", "reason").alias("v")).groupBy(key).agg(F.max("v").alias("v"))
    out = items.join(given.select(key, "v.*"), key, "left")
    valid = valid_list(F.col("pillars"), choices)
    reason = (
        F.when(F.col("passed").isNull(), "error").when(~F.col("passed"), F.coalesce(blank_to_null(F.col("reason")), F.lit("rejected")))
        .when(F.size(valid) == 0, "no valid category")
    )
    return out.withColumn("drop_reason", reason).withColumn("pillars", valid).withColumn("kept", F.col("drop_reason").isNull())


def in_or_blank(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is in the set or missing (FIL-08)."""
    c = blank_to_null(F.col(column))
    return df.where(c.isNull() | c.isin(values))


def not_in(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is not in the set; missing passes (FIL-09)."""
    return df.where(~F.coalesce(F.col(column), F.lit("")).isin(values))


def half_open(df: DataFrame, *, date: str, as_of: str, days: int) -> DataFrame:
    """The digest window: ``as_of`` itself excluded (FIL-13)."""
    end = F.lit(as_of).cast("date")
    return df.where((F.col(date) >= F.date_sub(end, days)) & (F.col(date) < end))


def facets(df: DataFrame, *, since: str | None = None, date: str = "date", categories: list[str] | None = None, category_column: str = "competency", empty_shows_all: bool = False, show_uncategorised: bool = False, equal: dict[str, str] | None = None, contains: dict[str, str] | None = None) -> DataFrame:
    """A faceted query (FIL-14 to FIL-18).

    ``categories``: any match; none chosen shows every categorised row where ``empty_shows_all``, else nothing.
    ``show_uncategorised`` adds rows without a category. ``equal`` and ``contains`` filter scalar and list columns.
    """
    conditions: list[Column] = []
    if since is not None:
        conditions.append(F.col(date) >= F.lit(since).cast("date"))
    if categories is not None:
        some = F.size(category_column) > 0
        match = F.arrays_overlap(category_column, F.array(*map(F.lit, categories))) if categories else (some if empty_shows_all else F.lit(False))
        conditions.append(match | ~some if show_uncategorised else match)
    conditions += [F.col(c) == v for c, v in (equal or {}).items()]
    conditions += [F.array_contains(c, v) for c, v in (contains or {}).items()]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def review_layer(df: DataFrame, *, cutoff: str, relevant_only: bool = False, date: str = "date", relevance_field: str = "competency") -> DataFrame:
    """Rows of a review layer from the cutoff on, without an end; undated ones go (REP-04).

    ``relevant_only`` keeps rows whose list of categories is not empty: ``competency`` of events, hearings and bills,
    ``pillars`` of raw layers.
    """
    rows = df.where(F.col(date) >= F.lit(cutoff).cast("date"))
    return rows.where(F.size(F.coalesce(F.col(relevance_field), F.array().cast("array<string>"))) > 0) if relevant_only else rows


def moved_bills(df: DataFrame, *, as_of: str, days: int, actions: tuple[str, ...] = ("marked-up", "reported"), relevance: int = 2, category: str | None = None) -> DataFrame:
    """Bills that a committee moved in the window, by committee date else date (FIL-19); with a ``category``, where given."""
    if category is not None:
        df = df.where(F.size(category) > 0)
    dated = df.withColumn("moved_on", F.coalesce("committee_action_date", "date"))
    return half_open(dated, date="moved_on", as_of=as_of, days=days).where(F.col("committee_action").isin(*actions) & (F.col("relevance") >= relevance))


#: A status and the phrases of which one (any) or each (all) must stand in the action, in this order.
BILL_STATUS = [
    ("enacted", "any", ["became public law", "signed by president"]),
    ("vetoed", "any", ["vetoed"]),
    ("passed-both", "all", ["passed senate", "passed house"]),
    ("passed-chamber", "any", ["passed", "agreed to"]),
    ("reported", "any", ["reported"]),
    ("in-committee", "any", ["referred to", "committee"]),
]


def bill_status(text: Column) -> Column:
    """Status by the first rule of ``BILL_STATUS`` that fits, else ``introduced`` (FIL-21)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit("introduced")
    for status, how, phrases in reversed(BILL_STATUS):
        found = [t.contains(p) for p in phrases]
        out = F.when(reduce(lambda a, b: a | b if how == "any" else a & b, found), status).otherwise(out)  # noqa: B023
    return out


def hearing_status(status: Column, date: Column, as_of: str) -> Column:
    """A scheduled hearing of a past day counts as held (FIL-22)."""
    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    return (
        F.when(s.isin("canceled", "cancelled"), "canceled").when(s == "postponed", "postponed")
        .when((s == "scheduled") & (date >= F.lit(as_of).cast("date")), "scheduled").otherwise("held")
    )


#: Committee relationship to action.
RELATIONSHIPS = {"markup by": "marked-up", "reported by": "reported", "referred to": "referred"}


def committee_action(relationship: Column) -> Column:
    """(FIL-23)"""
    low = F.lower(F.trim(F.coalesce(relationship, F.lit(""))))
    out = F.lit("other")
    for phrase, action in RELATIONSHIPS.items():
        out = F.when(low == phrase, action).otherwise(out)
    return out


def row_label(lead: Column, title: Column, most: int = 250) -> Column:
    """``lead — title``, cut (FIL-24)."""
    return F.substring(F.concat_ws(" — ", blank_to_null(lead), blank_to_null(title)), 1, most)
