"""Dates: reading them, reporting ranges, calendars."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format of dates, the zone "today" is taken in, the scheduled ranges.
DATE_FORMAT = "%Y-%m-%d"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
REPORT_ZONE = "Asia/Ho_Chi_Minh"
MODES = ("today", "last3days", "last7days", "thismonth", "lastmonth")


def to_day(text: Column) -> Column:
    """Date of a YYYY-MM-DD text, null for anything else."""
    text = text.cast("string")
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def date_range(mode: str, as_of: date | None = None) -> tuple[date, date]:
    """First and last day of a scheduled range, both included."""
    day = as_of or datetime.now(ZoneInfo(REPORT_ZONE)).date()
    month_start = day.replace(day=1)
    before_month = month_start - timedelta(days=1)
    ranges = {
        "today": (day, day),
        "last3days": (day - timedelta(days=3), day - timedelta(days=1)),
        "last7days": (day - timedelta(days=7), day - timedelta(days=1)),
        "thismonth": (month_start, day),
        "lastmonth": (before_month.replace(day=1), before_month),
    }
    if mode not in ranges:
        raise ValueError(f"unsupported mode {mode!r}; use one of {', '.join(MODES)}")
    return ranges[mode]


def explicit_range(start: str, end: str) -> tuple[date, date]:
    """The range of a backfill: two YYYY-MM-DD texts, in order."""
    try:
        lo, hi = (datetime.strptime(text, DATE_FORMAT).date() for text in (start, end))
    except ValueError as error:
        raise ValueError("start and end must be dates written YYYY-MM-DD") from error
    if lo > hi:
        raise ValueError(f"start {lo} is after end {hi}")
    return lo, hi


def days_between(lo: Column, hi: Column) -> Column:
    """One row per day from ``lo`` to ``hi``; none where a bound is null."""
    return F.explode(F.sequence(lo, hi, F.expr("interval 1 day")))
