"""Bucketed key sets and bitmaps of dense ids."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import bitmaps
from tidegauge.sources.bucketed import BucketedSet

START = date(2024, 1, 1)
SCHEMA = "member_id string, instance_id string, first_day date"


def keys(spark, low, high, day=1):
    rows = [(str(i), str(i % 7), date(2024, 1, day)) for i in range(low, high)]
    return spark.createDataFrame(rows, SCHEMA)


def bucketed(spark, path, buckets=4):
    return BucketedSet.of(spark, str(path), "period_start", START, ("member_id", "instance_id"), buckets)


def rows_of(spark, path):
    return sorted((int(r["member_id"]), r["first_day"].day) for r in spark.read.parquet(str(path)).collect())


def test_append_adds_only_unseen_keys(spark, tmp_path):
    own = bucketed(spark, tmp_path)
    assert own.stored() is None
    own.append(keys(spark, 0, 50))
    own.append(keys(spark, 30, 80, day=2))
    own.append(keys(spark, 30, 80, day=3))
    assert rows_of(spark, tmp_path) == [(i, 1) for i in range(50)] + [(i, 2) for i in range(50, 80)]
    own.append(keys(spark, 0, 0))
    assert own.stored().count() == 80


def test_replace_and_layout_are_kept(spark, tmp_path):
    own = bucketed(spark, tmp_path, 4)
    own.append(keys(spark, 0, 50))
    own.replace(keys(spark, 10, 12, day=5))
    assert rows_of(spark, tmp_path) == [(10, 5), (11, 5)]
    again = bucketed(spark, tmp_path, 9)  # the stored layout counts
    assert again.buckets == 4
    again.append(keys(spark, 11, 13, day=6))
    assert rows_of(spark, tmp_path) == [(10, 5), (11, 5), (12, 6)]
    names = [f for f in os.listdir(tmp_path / f"period_start={START}") if f.endswith(".parquet")]
    assert {int(n.split("_")[-1].split(".")[0]) for n in names} <= set(range(4))


def test_stored_side_is_not_shuffled(spark, tmp_path):
    own = bucketed(spark, tmp_path)
    own.append(keys(spark, 0, 500))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = own.unseen(keys(spark, 400, 600))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # that of the new keys
    lines = plan.splitlines()
    exchange = next(i for i, x in enumerate(lines) if "Exchange" in x)
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    assert exchange < scan and "Scan" in "".join(lines[exchange + 1 : scan])  # it stands above the other scan


def test_dictionary_keeps_numbers_dense(spark, tmp_path):
    path = str(tmp_path / "ids")
    first = spark.createDataFrame([("a",), ("b",), (None,), ("a",), ("é",)], "member_id string")
    known = {r["key"]: r["id"] for r in bitmaps.grown_dictionary(spark, path, first).collect()}
    assert sorted(known.values()) == [1, 2, 3] and set(known) == {"a", "b", "é"}
    more = spark.createDataFrame([("b",), ("c",), ("d",)], "k string")
    for _ in range(2):  # a run again adds nothing
        later = {r["key"]: r["id"] for r in bitmaps.grown_dictionary(spark, path, more).collect()}
        assert sorted(later.values()) == [1, 2, 3, 4, 5] and known.items() <= later.items()
    assert bitmaps.grown_dictionary(spark, str(tmp_path / "none"), first.limit(0)).count() == 0


@pytest.mark.parametrize("kinds", [50, 70_000])
def test_merged_bitmaps_count_distinct_values(spark, tmp_path, kinds):
    """More numbers than one bitmap holds, days in any order, and weeks as ORs of days."""
    facts = spark.range(100_000).select(
        (F.col("id") % 9).alias("day"), F.pmod(F.xxhash64("id"), F.lit(kinds)).cast("string").alias("m")
    ).withColumn("m", F.when(F.col("m") != "3", F.col("m")))
    dictionary = bitmaps.grown_dictionary(spark, str(tmp_path / "ids"), facts.select("m"))
    days = bitmaps.bitmaps_of(facts, dictionary, "m", "day")
    days.write.partitionBy("day").parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    week = (F.col("day") / 4).cast("int").alias("week")
    got = bitmaps.count_bits(bitmaps.merged_bitmaps(days, week), "week")
    expected = facts.groupBy(week).agg(F.countDistinct("m").alias("num"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    by_day = {r["day"]: r["num"] for r in bitmaps.count_bits(days, "day").collect()}
    assert by_day == {r["day"]: r["n"] for r in facts.groupBy("day").agg(F.countDistinct("m").alias("n")).collect()}
    assert bitmaps.stored_bytes(spark, str(tmp_path / "days")) > 0


def test_bitmaps_are_smaller_than_key_sets_when_days_repeat(spark, tmp_path):
    draw = random.Random(1)
    facts = spark.createDataFrame([(d, f"member-{draw.randrange(4000)}") for d in range(5) for _ in range(4000)], "day int, m string")
    dictionary = bitmaps.grown_dictionary(spark, str(tmp_path / "ids"), facts.select("m"))
    bitmaps.bitmaps_of(facts, dictionary, "m", "day").write.parquet(str(tmp_path / "days"))
    facts.distinct().write.parquet(str(tmp_path / "keys"))
    assert bitmaps.stored_bytes(spark, str(tmp_path / "days")) < bitmaps.stored_bytes(spark, str(tmp_path / "keys"))
    assert bitmaps.stored_bytes(spark, str(tmp_path / "ids")) > 0
