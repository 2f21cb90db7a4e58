"""Incremental distinct counts over weeks and months.

A day's log is read once, into distinct daily facts. Weeks and months keep sets
of keys that each day's facts are merged into, so a month's distinct count never
reads the month's log again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timebuckets import date_of_seconds, day_epoch, day_of, period_start
from tidegauge.operators.filters import has_ids, not_openapi
from tidegauge.schemas import ALL_CLIENTS, PERIOD_TYPE

# Ids that make up each kind of key set: members, enterprises, members of enterprises.
KEY_SETS = {
    "uv": ("member_id",),
    "ev": ("instance_id",),
    "eu": ("instance_id", "member_id"),
}


def daily_facts(df: DataFrame, ts: str = "ts", tz: str = "UTC") -> DataFrame:
    """Distinct ``(day, member_id, instance_id)`` with both ids known, open API left out."""
    known = df.where(not_openapi() & has_ids("member_id", "instance_id"))
    return known.select(day_of(ts, tz).alias("day"), "member_id", "instance_id").distinct()


def facts_of_usage(usage: DataFrame, tz: str = "UTC") -> DataFrame:
    """The same from folded daily rows, whose ``created`` is the day's start."""
    known = usage.where(not_openapi() & has_ids("member_id", "instance_id"))
    day = date_of_seconds("created", tz).alias("day")
    return known.select(day, "member_id", "instance_id").distinct()


def period_keys(facts: DataFrame, unit: str, ids: tuple[str, ...]) -> DataFrame:
    """Distinct ids per week or month of daily facts."""
    return facts.select(period_start("day", unit).alias("period_start"), *ids).distinct()


def first_days(facts: DataFrame, unit: str, ids: tuple[str, ...]) -> DataFrame:
    """Ids per week or month with the first day that has them."""
    start = period_start("day", unit).alias("period_start")
    return facts.groupBy(start, *ids).agg(F.min("day").alias("first_day"))


def counts_so_far(keys: DataFrame, days: DataFrame) -> DataFrame:
    """``(period_start, day, num)``: keys of :func:`first_days` known by each of ``days``.

    Keys are counted per first day before they meet the days, which are at most 31 a period.
    """
    fresh = keys.groupBy("period_start", "first_day").agg(F.count(F.lit(1)).alias("fresh"))
    met = days.join(fresh, "period_start").where(F.col("first_day") <= F.col("day"))
    return met.groupBy("period_start", "day").agg(F.sum("fresh").alias("num"))


def merge_keys(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two key sets. Merging the same keys again changes nothing."""
    return stored.unionByName(new).distinct()


def unseen_keys(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Keys to append to a stored set: distinct, and not in it yet."""
    return new.distinct().join(stored, new.columns, "left_anti")


def count_keys(
    keys: DataFrame, unit: str, value: str, as_of: date, clients: bool = False, tz: str = "UTC"
) -> DataFrame:
    """Distinct ``value`` per period so far, with ``created`` = as-of day."""
    is_set = set(keys.columns) == {"period_start", value}
    counter = F.count(value) if is_set else F.countDistinct(value)
    counted = keys.groupBy("period_start").agg(counter.alias("num"))
    labels = [F.lit(PERIOD_TYPE[unit]).alias("type")]
    if clients:
        labels.append(F.lit(ALL_CLIENTS).alias("client_type"))
    return counted.select(*labels, "period_start", day_epoch(F.lit(as_of), tz).alias("created"), "num")
