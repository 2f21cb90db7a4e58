"""Metrics of a cohort: paying enterprises, or a list of members."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timebuckets import date_of_seconds, day_epoch
from tidegauge.operators.intervals import keep_covered
from tidegauge.operators.joins import keep_matching


def paid_at(payments: DataFrame, as_of: date, tz: str = "UTC") -> DataFrame:
    """Distinct ``instance_id`` with a payment above zero that covers the as-of day's start."""
    moment = day_epoch(F.lit(as_of), tz)
    valid = (F.col("start") <= moment) & (F.col("end") >= moment) & (F.col("total_fee") > 0)
    return payments.where(valid).select("instance_id").distinct()


def keep_members_of(
    df: DataFrame, payments: DataFrame, as_of: date, on: str = "instance_id", tz: str = "UTC"
) -> DataFrame:
    """Rows of enterprises that are paying at the as-of day."""
    return keep_matching(df, paid_at(payments, as_of, tz).withColumnRenamed("instance_id", on), on)


def paid_days(
    payments: DataFrame, first: date | None = None, last: date | None = None, tz: str = "UTC"
) -> DataFrame:
    """Distinct ``(instance_id, created)`` for each day start a payment covers.

    Turning intervals into days makes the range condition an equality, so a busy
    enterprise with many payments is not compared pair by pair. ``first`` and
    ``last`` leave out days that no caller asks for; a payment has an end in any case.
    """
    # A zone's day can start up to a day before or after the UTC one.
    low = F.greatest(F.date_sub(date_of_seconds("start"), 1), F.lit(first).cast("date"))
    high = F.least(F.date_add(date_of_seconds("end"), 1), F.lit(last).cast("date"))
    spans = (
        payments.where((F.col("total_fee") > 0) & (F.col("start") <= F.col("end")))
        .select("instance_id", "start", "end", low.alias("low"), high.alias("high"))
        .where(F.col("low") <= F.col("high"))
        .distinct()
    )
    days = spans.select("*", F.explode(F.sequence("low", "high")).alias("day"))
    starts = days.withColumn("created", day_epoch("day", tz))
    covered = starts.where(F.col("created").between(F.col("start"), F.col("end")))
    return covered.select("instance_id", "created").distinct()


def keep_paid_on_day(
    df: DataFrame,
    payments: DataFrame,
    first: date | None = None,
    last: date | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Rows whose enterprise is paying on the row's own day (``created``)."""
    return keep_matching(df, paid_days(payments, first, last, tz), "instance_id", "created")


def keep_paid_at(df: DataFrame, payments: DataFrame, at: str = "ts", on: str = "instance_id") -> DataFrame:
    """Rows whose enterprise is paying at the row's own instant, to the microsecond.

    ``payments`` has ``start`` and ``end`` as times; one without an end still runs.
    """
    paid = payments.where(F.col("total_fee") > 0).withColumnRenamed("instance_id", on)
    return keep_covered(df, paid, [on], at)
