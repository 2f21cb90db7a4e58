import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidegauge.functions.timebuckets import DAY
from tidegauge.operators import cohort

PAYMENTS = "instance_id string, start bigint, end bigint, total_fee double"


def test_paid_at_includes_both_ends_and_needs_a_fee(spark):
    day = 17000 * DAY
    rows = [
        ("starts", day, day + 9, 1.0),
        ("ends", day - 9, day, 1.0),
        ("free", day - 9, day + 9, 0.0),
        ("over", day - 9, day - 1, 1.0),
        ("later", day + 1, day + 9, 1.0),
        ("starts", day - 5, day + 9, 2.0),
    ]
    payments = spark.createDataFrame(rows, PAYMENTS)
    as_of = date(1970, 1, 1) + timedelta(days=17000)
    got = sorted(r["instance_id"] for r in cohort.paid_at(payments, as_of).collect())
    assert got == ["ends", "starts"]


def test_range_semi_join_by_brute_force(spark):
    rng = random.Random(7)
    payments = [
        (f"e{rng.randrange(6)}", s := rng.randrange(60 * DAY), s + rng.randrange(9 * DAY), fee)
        for fee in [0.0, 1.0, 2.5] * 40
    ]
    facts = [(f"e{rng.randrange(7)}", rng.randrange(70) * DAY) for _ in range(400)]
    facts += [(None, 5 * DAY)]
    expected = sorted(
        (e, d)
        for e, d in facts
        if any(i == e and s <= d <= t and fee > 0 for i, s, t, fee in payments)
    )
    df = spark.createDataFrame(facts, "instance_id string, created bigint")
    kept = cohort.keep_paid_on_day(
        df, spark.createDataFrame(payments, PAYMENTS), date(1970, 1, 1), date(1970, 4, 1)
    )
    assert sorted((r["instance_id"], r["created"]) for r in kept.collect()) == expected


def test_days_of_another_zone(spark):
    # Shanghai's 1970-01-02 starts at 57600; the payment covers just that moment.
    payments = spark.createDataFrame([("a", 57600, 57600, 1.0)], PAYMENTS)
    days = (date(1970, 1, 1), date(1970, 1, 9))
    there = cohort.paid_days(payments, *days, "Asia/Shanghai").collect()
    assert [tuple(r) for r in there] == [("a", 57600)]
    assert cohort.paid_days(payments, *days).count() == 0
    assert cohort.paid_at(payments, date(1970, 1, 2), "Asia/Shanghai").count() == 1


def test_range_semi_join_is_an_equality_join(spark):
    df = spark.createDataFrame([("a", 0)], "instance_id string, created bigint")
    payments = spark.createDataFrame([("a", 0, 9, 1.0)], PAYMENTS)
    kept = cohort.keep_paid_on_day(df, payments, date(1970, 1, 1), date(1970, 1, 2))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_paid_days_need_no_bounds(spark):
    day = 86_400
    payments = spark.createDataFrame([("1", 0, 400 * day, 5)], "instance_id string, start bigint, end bigint, total_fee int")
    found = cohort.paid_days(payments).agg(F.count("*"), F.max("created")).first()
    assert tuple(found) == (401, 400 * day)
