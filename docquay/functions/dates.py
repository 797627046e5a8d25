"""Month labels, date bounds and search windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH = "yyyy-MM"


def parse_bounds(start: str | None, end: str | None) -> tuple[date, date]:
    """Both bounds are required and must be ``YYYY-MM-DD``."""
    if not start or not end:
        raise ValueError("Both a start date and an end date are required (YYYY-MM-DD)")
    return tuple(datetime.strptime(d, "%Y-%m-%d").date() for d in (start, end))


def month_of(day: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.date_format(day, MONTH)


def month_of_text(day: Column) -> Column:
    """First seven characters of a date text."""
    return F.substring(day, 1, 7)


def published_on(published_date: Column) -> Column:
    """The published date as a date; null when the text is none."""
    return F.try_to_date(published_date, "d/M/yyyy")


def month_windows(start: Column, end: Column) -> Column:
    """Array of ``(from_date, to_date, partition)``, one for each month.

    Windows begin on day 1, also in the start month; the last one is cut at
    ``end``. A month that would begin on ``end`` or later is left out, and bounds
    in the wrong order give no window.
    """
    first = F.trunc(start, "MM")
    months = F.when(
        first < end, F.sequence(first, end, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
    return F.transform(
        F.filter(months, lambda day: day < end),
        lambda day: F.struct(
            F.date_format(day, "d/M/yyyy").alias("from_date"),
            F.date_format(F.least(F.last_day(day), end), "d/M/yyyy").alias("to_date"),
            month_of(day).alias("partition"),
        ),
    )
