"""Default periods of a job, from an explicit as-of time instead of the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta


def yesterday(as_of: datetime) -> date:
    return as_of.date() - timedelta(days=1)


def last_hour(as_of: datetime) -> datetime:
    return as_of.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)


def week_start(day: date) -> date:
    return day - timedelta(days=day.weekday())


def month_start(day: date) -> date:
    return day.replace(day=1)
