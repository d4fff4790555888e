"""Closed vocabularies and ordered lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_list(values: Column, choices: list[str]) -> Column:
    """Entries of a closed vocabulary; order and repeats stay (FIL-10)."""
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: x.isin(choices))


def valid_scalar(value: Column, choices: list[str], default: str | None) -> Column:
    """The value if it is in the vocabulary, else the default (FIL-11)."""
    return F.when(value.isin(choices), value).otherwise(F.lit(default))


def clamp_relevance(value: Column, categories: Column | None = None) -> Column:
    """1 to 3, else null; null too without a category (FIL-12).

    A fractional number is cut (2.7 counts as 2); a fraction in text is invalid.
    """
    text = F.trim(value.cast("string"))
    fraction = F.typeof(value).rlike("double|float|decimal")
    digit = F.when(fraction, F.regexp_extract(text, r"^([1-3])(\.\d+)?$", 1)).otherwise(F.regexp_extract(text, "^([1-3])$", 1))
    number = F.when(digit != "", digit.cast("int"))
    return number if categories is None else F.when(F.size(categories) > 0, number)


def primary(categories: Column, choices: list[str]) -> Column:
    """The first valid category (FUN-28)."""
    return F.get(valid_list(categories, choices), F.lit(0))


def also_line(categories: Column, choices: list[str]) -> Column:
    """``also x & y``: the other valid categories of an event, in vocabulary order; else empty (FUN-27)."""
    first = primary(categories, choices)
    others = F.filter(F.array(*map(F.lit, choices)), lambda c: F.array_contains(categories, c) & (c != first))
    return F.when(F.size(others) > 0, F.concat(F.lit("also "), F.array_join(others, " & "))).otherwise("")


def document_url(candidates: Column, own: Column) -> Column:
    """The first candidate that is none of the event's own sources (FIL-25)."""
    return F.get(F.filter(candidates, lambda d: d.isNotNull() & (d != "") & ~F.array_contains(own, d)), F.lit(0))


def ordered_union(a: Column, b: Column) -> Column:
    """Both lists, first seen first, without repeats (SET-03)."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))
