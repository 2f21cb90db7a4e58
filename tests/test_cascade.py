"""The stored runs, with days run again and emptied, against counts from scratch."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.plans import adapters, cascade, jobs
from tidegauge.plans.queries import QUERIES
from tidegauge.sources.app_events import parse_events

# Two weeks; the first day is run again after the later ones.
DAYS = [date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 7)]


@pytest.fixture(scope="module")
def world(spark, sf):
    users = adapters.users(spark, sf)
    hits = adapters.hits(spark, sf)
    log = adapters.with_org(hits, users).withColumn("d", F.to_date("ts"))
    log = log.where(F.col("d").between(min(DAYS), max(DAYS))).persist()
    payments = adapters.payments(hits, users).persist()
    yield log, payments
    log.unpersist()
    payments.unpersist()


def one_day(spark, root, world, day, keep="true"):
    log, payments = world
    rows = log.where((F.col("d") == day) & F.expr(keep)).drop("d")
    cascade.run_day(spark, root, rows, day, payments)


@pytest.fixture(scope="module")
def root(spark, world, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("cascade"))
    for day in DAYS:
        one_day(spark, root, world, day)
    hour = world[0].where(F.date_trunc("hour", "ts") == F.lit("2024-01-07 10:00:00").cast("timestamp"))
    cascade.run_hour(spark, root, hour.drop("d"), datetime(2024, 1, 7, 10))
    return root


def stored(spark, root, name):
    return spark.read.parquet(f"{root}/reports/{name}")


def same_rows(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(*left.columns).collect()))


def test_daily_reports_equal_one_run_over_all_days(spark, world, root):
    log = world[0].drop("d")
    fresh = {**jobs.visitor_reports(log, "day"), **jobs.enterprise_reports(log, "day")}
    visits = log.where("member_id is not null").groupBy(
        F.unix_timestamp(F.date_trunc("day", "ts")).alias("created"), "qz_id", "member_id"
    )
    fresh |= {"site": jobs.site_report(log), "member_visits": visits.agg(F.count("*").alias("times"))}
    for name, report in fresh.items():
        assert same_rows(report, stored(spark, root, name).where("part = 'day'")), name


def test_periods_so_far_are_right_for_every_day_after_a_rerun(spark, world, root):
    log = world[0].where("site <> 'openapi' AND member_id IS NOT NULL AND instance_id IS NOT NULL")
    facts = log.select(F.col("d").alias("day"), "member_id", "instance_id").distinct()
    for day in set(DAYS):
        for unit in cascade.UNITS:
            start = cascade.FLOORS[unit](day)
            known = jobs.period_reports(facts, unit, day)
            for name in ("uv", "ev"):
                kept = stored(spark, root, name).where((F.col("part") == unit) & (F.col("dt") == day))
                assert same_rows(known[name].where(F.col("period_start") == start), kept), (day, unit, name)


def test_key_sets_hold_every_key_once_with_its_first_day(spark, root):
    facts = spark.read.parquet(f"{root}/facts")
    for unit in cascade.UNITS:
        for kind, ids in cascade.KEY_SETS.items():
            keys = spark.read.parquet(f"{root}/{unit}_{kind}")
            whole = cascade.first_days(facts, unit, ids)
            assert keys.count() > 0 and same_rows(whole, keys)


def test_a_day_that_shrinks_or_empties_leaves_nothing_behind(spark, world, tmp_path):
    root = str(tmp_path / "again")
    one_day(spark, root, world, DAYS[1], "false")  # the very first run may be empty
    assert stored(spark, root, "uv").where("part = 'day'").count() == 0
    for day in DAYS[1:3]:
        one_day(spark, root, world, day)
    first = stored(spark, root, "enterprise_access").where(F.col("dt") == DAYS[1])
    some = first.agg(F.min("instance_id")).first()[0]
    one_day(spark, root, world, DAYS[1], f"instance_id = '{some}'")
    left = stored(spark, root, "enterprise_access").where(F.col("dt") == DAYS[1])
    assert [r["instance_id"] for r in left.collect()] == [some]
    one_day(spark, root, world, DAYS[1], "false")
    for name in ("uv", "ev", "site", "enterprise_access", "member_visits"):
        assert stored(spark, root, name).where((F.col("dt") == DAYS[1]) & (F.col("part") == "day")).count() == 0
    keys = spark.read.parquet(f"{root}/week_uv")
    assert {r["first_day"] for r in keys.select("first_day").distinct().collect()} == {DAYS[2]}


def test_weeks_published_together_stay_apart(spark, root):
    rows = stored(spark, root, "uv").where("part = 'week'").select("period_start").distinct()
    assert rows.count() == 2


def test_paid_counts_are_at_most_all(spark, root):
    for metric in ("uv", "ev"):
        whole = {(r["type"], r["created"]): r["num"] for r in stored(spark, root, metric).collect()}
        paid = stored(spark, root, f"paid_{metric}").collect()
        assert paid and all(r["num"] <= whole[r["type"], r["created"]] for r in paid)


def test_hourly_report_of_one_hour(spark, sf, root):
    for name in ("uv", "ipv", "ev"):
        hour = stored(spark, root, name).where("type = '1hour'").collect()
        assert [r["created"] for r in hour] == [1704621600]
        query = QUERIES[f"{name}_hour"](spark, sf).where(F.col("created") == 1704621600).first()
        assert hour[0]["num"] == query["num"]


def test_paid_days_equal_the_query(spark, sf, root):
    for metric in ("uv", "ev"):
        kept = stored(spark, root, f"paid_{metric}").where("type = '1day'").collect()
        query = QUERIES[f"paid_{metric}_day"](spark, sf).collect()
        whole = {r["created"]: r["num"] for r in query}
        assert kept and all(whole[r["created"]] == r["num"] for r in kept)


def test_app_usage_from_the_event_archive(spark, sf, tmp_path):
    root = str(tmp_path / "apps")
    events = parse_events(adapters.app_events(spark, sf)).withColumn("dt", F.to_date("ts"))
    events = events.where(F.col("dt").between(DAYS[0], DAYS[1])).withColumn("batch", F.lit(0))
    events.write.partitionBy("dt", "batch").parquet(f"{root}/events")
    apps = adapters.apps(spark, sf)
    seen = {}
    for day in (DAYS[0], DAYS[1], DAYS[0]):
        cascade.run_apps(spark, root, apps, day)
        registry = {(r["app_id"], r["open_appid"]): r["rpid"] for r in spark.read.parquet(f"{root}/registry").collect()}
        assert seen.items() <= registry.items()  # an app keeps its id
        seen = registry
    assert sorted(seen.values()) == list(range(1, len(seen) + 1))
    registry = spark.read.parquet(f"{root}/registry")
    assert registry.count() == len(seen)
    _, reports = jobs.app_usage(events.drop("dt", "batch"), apps, registry)
    for name, report in reports.items():
        assert same_rows(report, stored(spark, root, name)), name


def test_clicks_are_stored_beside_events(spark, sf, tmp_path):
    root = str(tmp_path / "clicks")
    log = spark.createDataFrame(
        [("1.1.1.1", "GET /wall/index HTTP/1.1", "agent", "1", "2", "3", "4")],
        "remote_addr string, request string, http_user_agent string, member_id string, qz_id string, "
        "user_id string, instance_id string",
    ).withColumn("ts", F.lit("2024-01-07 10:00:00").cast("timestamp"))
    for _ in range(2):
        cascade.store_clicks(spark, root, log, DAYS[0])
    found = spark.read.parquet(f"{root}/events")
    expected = cascade.derive_clicks(log).count()
    assert found.count() == expected and {"dt", "batch", "mtime", "object_id"} <= set(found.columns)
