"""Day ranges, both ends included."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_range(start: str | date | None, end: str | date | None) -> tuple[date, date] | None:
    """None when no bound is given; otherwise both bounds, in order."""
    if not start and not end:
        return None
    if not start or not end:
        raise ValueError("give both a start and an end day, or neither")
    first, last = _day(start), _day(end)
    if first > last:
        raise ValueError("the start day must not be after the end day")
    return first, last


def _day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def day_list(first: date, last: date) -> list[str]:
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def within_days(at: Column, first: date, last: date) -> Column:
    """From midnight of the first day up to, not including, midnight after the last."""
    lower = F.lit(first.isoformat()).cast("timestamp")
    upper = F.date_add(F.lit(last.isoformat()).cast("date"), 1).cast("timestamp")
    return (at >= lower) & (at < upper)


def dt_between(dt: Column, first: date, last: date) -> Column:
    """Same range on the folder day, which the scan prunes by."""
    return dt.between(F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date"))
