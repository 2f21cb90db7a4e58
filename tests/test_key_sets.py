from datetime import date

from pyspark.sql import functions as F

from tidegauge.operators import key_sets
from tidegauge.plans import adapters
from tidegauge.plans.queries import QUERIES
from tidegauge.sources.archive import append_partitioned, overwrite_partitions, read_periods

FACTS = "day date, member_id string, instance_id string"


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), FACTS)


def test_daily_facts_need_both_ids_and_leave_open_api_out(spark):
    rows = [
        (0, "m", "1", "2"),
        (9, "m", "1", "2"),
        (9, "m", None, "2"),
        (9, "m", "1", None),
        (9, "openapi", "1", "3"),
        (90000, "m", "1", "2"),
    ]
    df = spark.createDataFrame(rows, "s bigint, site string, member_id string, instance_id string")
    got = key_sets.daily_facts(df.withColumn("ts", F.timestamp_seconds("s")))
    assert sorted(tuple(r) for r in got.collect()) == [
        (date(1970, 1, 1), "1", "2"),
        (date(1970, 1, 2), "1", "2"),
    ]


def test_daily_facts_of_the_typed_log_equal_the_query(spark, sf):
    log = adapters.with_org(adapters.hits(spark, sf), adapters.users(spark, sf))
    got = {(str(r["day"]), r["member_id"], r["instance_id"]) for r in key_sets.daily_facts(log).collect()}
    query = QUERIES["daily_distinct_fact"](spark, sf).collect()
    assert got == {(r["day"], r["member_id"], r["instance_id"]) for r in query}


def test_sunday_belongs_to_the_week_before(spark):
    df = facts(spark, (date(2017, 1, 15), "a", "x"), (date(2017, 1, 16), "a", "x"))
    keys = key_sets.period_keys(df, "week", ("member_id",))
    assert sorted(r["period_start"] for r in keys.collect()) == [date(2017, 1, 9), date(2017, 1, 16)]


def test_daily_merges_equal_one_count_over_everything(spark, tmp_path):
    """A month kept day by day, with a day done twice, against a count from scratch."""
    path = str(tmp_path / "keys")
    days = [
        [("a", "x"), ("b", "x")],
        [("a", "x"), ("c", "y")],
        [("c", "y"), ("a", "y")],
    ]
    ids = key_sets.KEY_SETS["eu"]
    whole = facts(spark, *[(date(2017, 1, d + 1), m, i) for d, ks in enumerate(days) for m, i in ks])
    for d in (0, 1, 1, 2):
        day = date(2017, 1, d + 1)
        new = key_sets.period_keys(whole.where(F.col("day") == day), "month", ids)
        if d == 0:
            append_partitioned(new, path, "period_start")
            continue
        stored = read_periods(spark, path, "month", day, day).select(*new.columns)
        append_partitioned(key_sets.unseen_keys(stored, new), path, "period_start")
    kept = sorted((r["instance_id"], r["member_id"]) for r in spark.read.parquet(path).collect())
    assert kept == [("x", "a"), ("x", "b"), ("y", "a"), ("y", "c")]
    stored = spark.read.parquet(path)
    count = key_sets.count_keys(stored, "month", "member_id", date(2017, 1, 3)).first()
    assert (count["num"], count["created"], count["type"]) == (3, 1483401600, "thismonth")


def test_merging_twice_changes_nothing(spark, tmp_path):
    old = facts(spark, (date(2017, 1, 1), "a", "x")).withColumnRenamed("day", "period_start")
    new = facts(spark, (date(2017, 1, 1), "b", "x")).withColumnRenamed("day", "period_start")
    once = key_sets.merge_keys(old, new)
    twice = key_sets.merge_keys(once, new)
    assert sorted(once.collect()) == sorted(twice.collect())
    path = str(tmp_path / "keys")
    overwrite_partitions(once, path, "period_start")
    assert spark.read.parquet(path).count() == 2
