"""The daily and hourly runs over stored tables: facts, week and month key sets, reports.

Under one root folder: ``usage`` and ``app_usage`` by day, ``usage_hour`` by hour, ``facts`` by day,
``week_uv`` ... ``month_eu`` by period, ``events`` by day, the app ``registry``, and
``reports/<name>`` by day and part (the job that fills it). A step replaces just the partition it
is named for, also by nothing, so every step can be run again, for any day and in any order. Only
the first step of a run reads the log; the others read what it stored.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.asof import month_start, week_start
from tidegauge.functions.timebuckets import date_of_seconds, day_of
from tidegauge.operators.cohort import keep_members_of
from tidegauge.operators.enrich import derive_clicks
from tidegauge.operators.filters import has_ids, not_openapi
from tidegauge.operators.joins import lookup
from tidegauge.operators.key_sets import KEY_SETS, count_keys, facts_of_usage, first_days
from tidegauge.operators.metrics import fold
from tidegauge.plans.jobs import (
    APP_DIMS,
    Reports,
    app_keys,
    app_metrics,
    hourly_reports,
    paid_day_reports,
    usage_of,
    usage_reports,
)
from tidegauge.schemas import EVENT_FIELDS, REGISTRY_SCHEMA, REPORTS
from tidegauge.sources.archive import (
    read_days,
    read_if_stored,
    read_periods,
    replace_partition,
)
from tidegauge.sources.bucketed import BUCKETS, BucketedSet

UNITS = ("week", "month")
FLOORS = {"week": week_start, "month": month_start}


def store_usage(
    spark: SparkSession, root: str, log: DataFrame, day: date, tz: str = "UTC"
) -> DataFrame:
    """Folds a day's log into the stored usage and facts of that day; returns the usage."""
    usage = usage_of(log, "day", tz).where(date_of_seconds("created", tz) == F.lit(day))
    replace_partition(usage, f"{root}/usage", dt=day)
    stored = read_days(spark, f"{root}/usage", day, day)
    replace_partition(facts_of_usage(stored, tz), f"{root}/facts", day=day)
    return stored


def store_keys(spark: SparkSession, root: str, day: date, buckets: int = BUCKETS) -> None:
    """Adds one day's keys, with the day, to the sets of its week and month.

    Only keys that a set does not have are written, and only the day's keys are shuffled: the
    sets are stored in ``buckets``. If the set has keys of this or a later day already, the day is
    run again or late; then the set is made anew from the stored facts of its days, as a key may
    have another first day now, or none.
    """
    facts = read_days(spark, f"{root}/facts", day, day, "day")
    for unit in UNITS:
        start = FLOORS[unit](day)
        for kind, ids in KEY_SETS.items():
            path = f"{root}/{unit}_{kind}"
            keys = BucketedSet.of(spark, path, "period_start", start, ids, buckets)
            stored = keys.stored()
            if stored is None or stored.where(F.col("first_day") >= F.lit(day)).isEmpty():
                keys.append(first_days(facts, unit, ids))
            else:
                whole = read_days(spark, f"{root}/facts", start, start + timedelta(days=31), "day")
                whole = first_days(whole, unit, ids).where(F.col("period_start") == F.lit(start))
                keys.replace(whole)


def period_counts(
    spark: SparkSession, root: str, unit: str, day: date, payments: DataFrame, tz: str = "UTC"
) -> Reports:
    """UV and EV of the week or month of ``day`` up to that day, for all and for payers."""

    def keys(kind: str) -> DataFrame:
        table = read_if_stored(spark, f"{root}/{unit}_{kind}")
        if table is None or "period_start" not in table.columns:
            nothing = ", ".join(f"{c} string" for c in KEY_SETS[kind])
            return spark.createDataFrame([], f"period_start date, {nothing}")
        known = read_periods(spark, f"{root}/{unit}_{kind}", unit, day, day)
        return known.where(F.col("first_day") <= F.lit(day)).select("period_start", *KEY_SETS[kind])

    paid = keep_members_of(keys("eu"), payments, day, tz=tz)
    return {
        "uv": count_keys(keys("uv"), unit, "member_id", day, clients=True, tz=tz),
        "ev": count_keys(keys("ev"), unit, "instance_id", day, tz=tz),
        "paid_uv": count_keys(paid, unit, "member_id", day, tz=tz),
        "paid_ev": count_keys(paid, unit, "instance_id", day, tz=tz),
    }


def publish(root: str, part: str, reports: Reports, day: date, tz: str = "UTC") -> None:
    """Puts each report in place of what the same part stored for the day."""
    for name, report in reports.items():
        table = REPORTS[name]
        if "period_start" in table.keys and "period_start" not in report.columns:
            report = report.withColumn("period_start", date_of_seconds("created", tz))
        rows = report.select(*table.keys, *table.values)
        replace_partition(rows, f"{root}/reports/{name}", dt=day, part=part)


def run_day(
    spark: SparkSession,
    root: str,
    log: DataFrame,
    day: date,
    payments: DataFrame,
    tz: str = "UTC",
    buckets: int = BUCKETS,
) -> None:
    """Everything that follows from one day of the enriched log."""
    usage = store_usage(spark, root, log, day, tz)
    store_keys(spark, root, day, buckets)
    folded = usage.where(not_openapi() & has_ids("member_id", "instance_id"))
    publish(root, "day", usage_reports(usage), day, tz)
    publish(root, "day", paid_day_reports(folded, payments, day, day, tz), day, tz)
    for unit in UNITS:
        publish(root, unit, period_counts(spark, root, unit, day, payments, tz), day, tz)


def run_hour(
    spark: SparkSession, root: str, log: DataFrame, hour: datetime, tz: str = "UTC"
) -> None:
    """The hourly reports of one hour of the enriched log, which is read once."""
    day, hr = hour.date(), hour.hour
    replace_partition(usage_of(log, "hour", tz), f"{root}/usage_hour", dt=day, hr=hr)
    stored = read_days(spark, f"{root}/usage_hour", day, day).where(F.col("hr") == hr)
    publish(root, f"hour{hr:02d}", hourly_reports(stored), day, tz)


def store_clicks(
    spark: SparkSession, root: str, log: DataFrame, day: date, tz: str = "UTC"
) -> None:
    """Clicks derived from a day's log, beside the app events that streams have archived."""
    clicks = derive_clicks(log).where(day_of("ts", tz) == F.lit(day))
    missing = {c: F.lit(None).cast("string") for c in EVENT_FIELDS if c not in clicks.columns}
    rows = clicks.withColumns(missing).select(*EVENT_FIELDS, "ts")
    replace_partition(rows, f"{root}/events", dt=day, batch="clicks")


def run_apps(
    spark: SparkSession, root: str, apps: DataFrame, day: date, tz: str = "UTC"
) -> None:
    """App reports of one day of the event archive, which is read once.

    New apps are appended to the stored registry, so an app keeps its id for ever.
    """
    events = read_days(spark, f"{root}/events", day, day)
    replace_partition(fold(events, "day", *APP_DIMS, tz=tz), f"{root}/app_usage", dt=day)
    used = read_days(spark, f"{root}/app_usage", day, day)
    registry = read_if_stored(spark, f"{root}/registry")
    if registry is None:
        registry = spark.createDataFrame([], REGISTRY_SCHEMA)
    full, _ = app_keys(used, apps, registry)
    new = full.join(registry.select("rpid"), "rpid", "left_anti").select(*registry.columns)
    new.write.mode("append").parquet(f"{root}/registry")
    _, mapping = app_keys(used, apps, spark.read.parquet(f"{root}/registry"))
    publish(root, "day", app_metrics(lookup(used, mapping, "app_id", "rpid").where(has_ids("rpid"))), day, tz)
