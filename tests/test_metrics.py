"""Metrics by invariants and against plain Python over the same rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.labels import ELSEWHERE, REGION_CODES
from tidegauge.operators import filters, metrics
from tidegauge.plans import adapters, jobs
from tidegauge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def log(spark, sf):
    users = adapters.users(spark, sf)
    joined = adapters.with_org(adapters.hits(spark, sf), users).persist()
    yield joined
    joined.unpersist()


def rows(df, *names):
    return {tuple(r[n] for n in names[:-1]): r[names[-1]] for r in df.collect()}


def test_typed_log_job_equals_the_query(spark, sf, log):
    for unit in ("day", "hour"):
        reports = jobs.visitor_reports(log, unit)
        for metric in ("uv", "ipv"):
            query = QUERIES[f"{metric}_{unit}"](spark, sf)
            assert rows(reports[metric], "created", "num") == rows(query, "created", "num")
        reports = jobs.enterprise_reports(log, unit)
        query = QUERIES[f"enterprise_{unit}"](spark, sf)
        names = ("created", "instance_id", "uv")
        assert rows(reports["enterprise_access"], *names) == rows(query, *names)


def test_site_report_by_brute_force(log):
    seen = defaultdict(lambda: [set(), set(), 0, 0])
    for r in log.select(F.unix_seconds("ts").alias("s"), "*").collect():
        cell = seen[r["s"] // 86400 * 86400, r["site"]]
        if r["member_id"] is not None:
            cell[0].add(r["member_id"])
        cell[1].add(r["ip"])
        cell[2] += 1
        cell[3] += int(r["bytes_sent"]) if r["bytes_sent"].isdigit() else 0
    expected = {k: (len(v[0]), len(v[1]), v[2], v[3]) for k, v in seen.items()}
    got = {
        (r["created"], r["site"]): (r["uv"], r["ipv"], r["pv"], r["traffic"])
        for r in jobs.site_report(log).collect()
    }
    assert got == expected


def test_site_without_members_counts_zero(spark):
    df = spark.createDataFrame(
        [(0, "m", "1.1.1.1", None, "-"), (5, "m", "1.1.1.1", None, "7")],
        "s bigint, site string, ip string, member_id string, bytes_sent string",
    ).withColumn("ts", F.timestamp_seconds("s"))
    row = jobs.site_report(df).first()
    assert (row["uv"], row["pv"], row["ipv"], row["traffic"]) == (0, 2, 1, 7)


def test_hours_days_weeks_months_are_ordered(spark, sf):
    day = {r["created"]: r["num"] for r in QUERIES["uv_day"](spark, sf).collect()}
    for r in QUERIES["uv_hour"](spark, sf).collect():
        assert r["num"] <= day[r["created"] // 86400 * 86400]
    month = QUERIES["uv_month"](spark, sf).first()["num"]
    weeks = [r["num"] for r in QUERIES["uv_week"](spark, sf).collect()]
    assert max(day.values()) <= max(weeks) <= month


def test_region_counters_add_up_to_page_views(spark, sf, log):
    kept = log.where(filters.not_openapi() & ~filters.is_lan("net"))
    wide = QUERIES["pv_region_pivot"](spark, sf)
    counters = [c for c in wide.columns if c not in ("client_type", "created")]
    total = wide.agg(*[F.sum(c) for c in counters]).first()
    assert sum(total) == kept.count()


def test_wide_page_views_have_every_region_column(spark):
    long = spark.createDataFrame(
        [(1, "sichuan", 2), (1, ELSEWHERE, 3), (2, "local", 1)],
        "created bigint, region string, num bigint",
    )
    wide = {r["created"]: r.asDict() for r in metrics.page_views_wide(long).collect()}
    assert len(wide[1]) == 38
    assert set(wide[1]) - {"client_type", "created"} == {ELSEWHERE, *REGION_CODES.values()}
    assert (wide[1]["sichuan"], wide[1][ELSEWHERE], wide[1]["local"]) == (2, 3, 0)
    assert wide[2]["client_type"] == "all" and wide[2]["local"] == 1


def test_paid_is_at_most_all(spark, sf):
    for unit in ("day", "week", "month"):
        for metric in ("uv", "ev"):
            key = "created" if unit == "day" else "period_start"
            whole = rows(QUERIES[f"{metric}_{unit}"](spark, sf), key, "num")
            paid = rows(QUERIES[f"paid_{metric}_{unit}"](spark, sf), key, "num")
            assert paid and all(num <= whole[k] for k, num in paid.items())


def test_distinct_day_and_hour_ignores_missing_values(spark):
    df = spark.createDataFrame(
        [(10, "a"), (3700, "a"), (3800, None), (90000, None)], "s bigint, m string"
    ).withColumn("ts", F.timestamp_seconds("s"))
    got = rows(metrics.distinct_day_and_hour(df, "m"), "type", "created", "num")
    assert got == {("1day", 0): 1, ("1hour", 0): 1, ("1hour", 3600): 1}


def test_top_keys_is_stable_and_repeat_keys_excludes_single(spark):
    df = spark.createDataFrame([(k,) for k in "aabbcd"], "k string")
    counts = metrics.count_by(df, "k")
    assert [tuple(r) for r in metrics.top_keys(counts, 3, "k").collect()] == [
        ("a", 2),
        ("b", 2),
        ("c", 1),
    ]
    repeated = Counter({r["k"]: r["num"] for r in metrics.repeated_keys(counts).collect()})
    assert repeated == Counter(a=2, b=2)


def test_buckets_of_another_zone(spark):
    df = spark.createDataFrame([(57599, "a"), (57600, "b")], "s bigint, m string").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    got = rows(metrics.distinct_per_period(df, "day", "m", tz="Asia/Shanghai"), "created", "num")
    assert got == {(-28800,): 1, (57600,): 1}
