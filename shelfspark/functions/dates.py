"""Dates in text and date text (FN21, FN22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that carry the arrival date, in order of preference.
ARRIVAL_PATTERNS = (
    r"Arrives by \w+?, (\w+? \d+)",
    r"Available \w+?, (\w+? \d+)",
    r"Free pickup \w+?, (\w+? \d+)",
)


def any_date(text: Column, *patterns: str) -> Column:
    """First pattern that reads the text as a date, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])


def days_to_arrival(text: Column, today: Column) -> Column:
    """Whole days from ``today`` to the month and day named in the text, in today's year."""
    found = F.coalesce(*[F.when(text.rlike(p), F.regexp_extract(text, p, 1)) for p in ARRIVAL_PATTERNS])
    dated = F.concat_ws(" ", found, F.date_format(today, "yyyy"))
    arrival = F.when(found.isNotNull(), any_date(dated, "MMM d yyyy", "MMMM d yyyy"))
    return F.datediff(arrival, today)


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def iso_text(ts: Column) -> Column:
    """ISO 8601 text; the fraction appears only when it is not zero."""
    fraction = F.date_format(ts, ".SSSSSS")
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def crawl_date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
