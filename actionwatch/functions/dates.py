"""Dates: lenient parsing, ingestion time, epochs. Nothing raises; what cannot be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


#: Shapes of a date in running text, in the order in which they are tried, and the groups of its year, month
#: and day. Years are those of this century, but for those after a slash.
SHAPES = [
    (r"(20\d\d)-(\d{2})-(\d{2})", (1, 2, 3)),
    (r"([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(20\d\d)", (3, 1, 2)),
    (r"\b(\d{1,2})\.(\d{1,2})\.(20\d\d)\b", (3, 1, 2)),
    (r"\b(\d{1,2})/(\d{1,2})/(\d{2,4})\b", (3, 1, 2)),
]


def parse_date(text: Column) -> Column:
    """The date that the first shape of ``SHAPES`` found in a text gives (FUN-06).

    A month's name counts by its first three letters; words that name no month are no date. Years below 100 are those of
    this century. The first shape found decides: where it is no day of the calendar, the date is null.
    """
    text = F.coalesce(text, F.lit(""))
    names = F.array(*(F.lit(m[:3]) for m in MONTHS))
    date = F.lit(None).cast("date")
    for shape, groups in reversed(SHAPES):
        year, month, day = (F.regexp_extract(text, shape, g) for g in groups)
        if "[A-Za-z]" in shape:
            month = F.array_position(names, F.lower(F.substring(month, 1, 3)))
            found = month > 0
        else:
            found = month != ""
        year = F.nullif(year, F.lit("")).cast("int")
        year = F.when(year < 100, year + 2000).otherwise(year)
        parts = [F.lpad(p.cast("string"), n, "0") for p, n in ((year, 4), (month, 2), (day, 2))]
        date = F.when(found, F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd")).otherwise(date)
    return date


def slug_date(url: Column) -> Column:
    """A trailing MMDDYYYY of a URL's slug (FUN-07)."""
    digits = F.regexp_extract(url, r"(\d{8})/?$", 1)
    return F.try_to_date(F.when(digits != "", digits), "MMddyyyy")


def verdict_date(text: Column, fallback: Column) -> Column:
    """The verdict's date where it is YYYY-MM-DD, else the publish date (FUN-10)."""
    return F.coalesce(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd")), fallback)


def when_ingested(ingested_at: Column, date: Column) -> Column:
    """Day of ingestion, else the action date (FUN-11)."""
    return F.coalesce(F.to_date(ingested_at), date)


def epoch_day(text: Column) -> Column:
    """Days since 1970 of an ISO date; 0 where it cannot be read (FUN-12)."""
    return F.coalesce(F.unix_date(F.try_to_date(text, "yyyy-MM-dd")), F.lit(0))
