"""Dates, flags and ids in the forms that exports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_midnight(c: Column) -> Column:
    """YYYY-MM-DDT00:00:00 of a date text; null unless its first ten characters are all there."""
    day = F.substring(c.cast("string"), 1, 10)
    return F.when(F.length(day) == 10, F.concat(day, F.lit("T00:00:00")))


def year_of(c: Column) -> Column:
    """The first four characters as a year; null where they are no number."""
    return F.substring(c.cast("string"), 1, 4).try_cast("int")


def compact_date(c: Column) -> Column:
    """YYYYMMDD and YYYYMM with hyphens; a month and day of 0000, or a month of 00, leave the year alone."""
    year, month, day = F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    full = F.when(F.substring(c, 5, 4) == "0000", year).otherwise(F.concat_ws("-", year, month, day))
    short = F.when(month == "00", year).otherwise(F.concat_ws("-", year, month))
    return F.when(F.length(c) == 8, full).when(F.length(c) == 6, short).otherwise(c)


def status(start: Column, end: Column, today: Column | None = None) -> Column:
    """valid, expired or future, by the day; without a start the end alone counts."""
    today = F.current_date() if today is None else today
    return F.when(end < today, "expired").when(start > today, "future").otherwise("valid")


def valid_year_or_day(c: Column) -> Column:
    """YYYY, or YYYYMMDD where that is a day."""
    return c.rlike(r"^\d{4}$") | (c.rlike(r"^\d{8}$") & F.try_to_date(c, "yyyyMMdd").isNotNull())


def yes_no(c: Column, yes: str = "oui", no: str = "non") -> Column:
    """yes for 1, no for 0, and null for anything else, also for a text that is no number."""
    n = c.try_cast("int")
    return F.when(n == 1, yes).when(n == 0, no)


def id_text(c: Column) -> Column:
    """An id as text; 0, as number or text, is the empty text."""
    return F.when(c.try_cast("double") == 0, "").otherwise(c.cast("string"))
