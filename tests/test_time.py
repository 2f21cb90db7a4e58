from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import asof
from tidegauge.functions import timebuckets as t


def test_log_time_reads_offset_and_rejects_rubbish(column):
    seconds = column(
        F.unix_seconds(t.log_time("c")),
        ["[07/Jan/2017:23:59:52 +0800]", "07/Jan/2017:15:59:52 +0000", "[broken]", "", None],
    )
    assert seconds == [1483804792, 1483804792, None, None, None]


@pytest.mark.parametrize(
    "unit, expected",
    [
        ("second", 1483815600),
        ("hour", 1483815600),
        ("day", 1483747200),
        ("week", 1483315200),
        ("month", 1483228800),
    ],
)
def test_bucket_in_utc(column, unit, expected):
    # 2017-01-08 03:00:00 +0800 is 2017-01-07 19:00 UTC, a Saturday.
    assert column(t.bucket(t.log_time("c"), unit), ["[08/Jan/2017:03:00:00 +0800]"]) == [expected]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = (
            spark.createDataFrame([("[08/Jan/2017:03:00:00 +0800]",)], "c string")
            .select(t.log_time("c").alias("ts"))
            .select(
                t.bucket("ts", "day").alias("utc"),
                t.bucket("ts", "day", "Asia/Shanghai").alias("shanghai"),
                t.day_of("ts").alias("utc_day"),
                t.day_of("ts", "Asia/Shanghai").alias("shanghai_day"),
                t.hour_of("ts", "Asia/Shanghai").alias("hour"),
                t.time_text("ts", t.DAY_TIME_TEXT, "Asia/Shanghai").alias("text"),
            )
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["utc"] == 1483747200
    assert row["shanghai"] == 1483804800
    assert row["utc_day"] == date(2017, 1, 7)
    assert row["shanghai_day"] == date(2017, 1, 8)
    assert row["hour"] == 3
    assert row["text"] == "2017:01:08:03:00:00"


def test_buckets_over_daylight_saving_change(column):
    # New York's 2017-03-12 has 23 hours; its day starts at 05:00 UTC.
    seconds = [1489294800, 1489294800 + 22 * 3600, 1489294800 + 23 * 3600]
    days = column(t.bucket_of_seconds("c", "day", "America/New_York"), seconds, "bigint")
    assert days == [1489294800, 1489294800, 1489294800 + 23 * 3600]


def test_week_and_month_starts(column):
    days = [date(2017, 1, 15), date(2017, 1, 16), date(2016, 12, 31)]
    assert column(t.period_start("c", "week"), days, "date") == [
        date(2017, 1, 9),
        date(2017, 1, 16),
        date(2016, 12, 26),
    ]
    assert column(t.period_start("c", "month"), days, "date")[2] == date(2016, 12, 1)


def test_times_before_the_epoch_round_down(column):
    assert column(t.bucket_of_seconds("c", "hour"), [-1, -3600, -3601], "bigint") == [
        -3600,
        -3600,
        -7200,
    ]


def test_millis_and_day_text(column):
    assert column(t.bucket_of_millis("c", "day"), [1500000000123], "bigint") == [1499990400]
    assert column(t.day_text_epoch("c"), ["2017:01:08", "x", None]) == [1483833600, None, None]
    assert column(t.day_text_epoch("c", "Asia/Shanghai"), ["2017:01:08"]) == [1483804800]


def test_seconds_between_counts_whole_seconds_towards_zero(spark):
    df = spark.sql("SELECT timestamp'2017-01-01 00:00:01.5' a, timestamp'2017-01-01 00:00:00' b")
    row = df.select(t.seconds_between("a", "b"), t.seconds_between("b", "a")).first()
    assert tuple(row) == (1, -1)


def test_text_patterns(column):
    parsed = column(
        t.time_of_text("c", t.MINUTE_KEY).cast("string"), ["201701082359", "20170108", None]
    )
    assert parsed == ["2017-01-08 23:59:00", None, None]


def test_as_of_periods():
    now = datetime(2017, 1, 1, 0, 20)
    assert asof.yesterday(now) == date(2016, 12, 31)
    assert asof.last_hour(now) == datetime(2016, 12, 31, 23)
    assert asof.week_start(date(2017, 1, 15)) == date(2017, 1, 9)
    assert asof.month_start(date(2016, 12, 31)) == date(2016, 12, 1)


def test_unusable_milliseconds_are_null(column):
    values = [0, -1, 99_999_999_999_999_999, -(2**63), 2**63 - 1, 253_402_300_800_000, None]
    seconds = column(F.unix_seconds(t.instant_of_millis("c")), values, "bigint")
    assert seconds == [0, -1, None, None, None, None, None]
    assert column(t.bucket_of_millis("c", "day"), values, "bigint") == [0, -86400, *[None] * 5]
    assert column(t.date_of_millis("c"), values, "bigint") == [date(1970, 1, 1), date(1969, 12, 31), *[None] * 5]
