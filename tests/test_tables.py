from datetime import date

from tidegauge.operators.tables import merge_add, merge_replace
from tidegauge.sources.archive import replace_partition

SITE = "site string, created bigint, uv bigint, pv bigint"


def as_dict(df):
    return {(r["site"], r["created"]): (r["uv"], r["pv"]) for r in df.collect()}


def test_replace_overwrites_adds_and_keeps(spark):
    target = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 2, 2), (None, 1, 3, 3)], SITE)
    updates = spark.createDataFrame([("b", 1, 9, 9), ("c", 1, 8, 8), (None, 1, 7, 7)], SITE)
    merged = merge_replace(target, updates, ["site", "created"], ["uv", "pv"])
    expected = {("a", 1): (1, 1), ("b", 1): (9, 9), ("c", 1): (8, 8), (None, 1): (7, 7)}
    assert as_dict(merged) == expected
    again = merge_replace(merged, updates, ["site", "created"], ["uv", "pv"])
    assert as_dict(again) == expected


def test_jobs_may_fill_different_columns_of_a_row(spark):
    target = spark.createDataFrame([("a", 1, 1, None)], SITE)
    pv = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "site string, created bigint, pv bigint")
    merged = merge_replace(target, pv, ["site", "created"], ["pv"])
    assert as_dict(merged) == {("a", 1): (1, 5), ("b", 1): (None, 6)}


def test_add_sums_and_treats_missing_as_zero(spark):
    target = spark.createDataFrame([("a", 1, 1, None)], SITE)
    updates = spark.createDataFrame([("a", 1, 2, 3), ("b", 1, 4, 5)], SITE)
    merged = merge_add(target, updates, ["site", "created"], ["uv", "pv"])
    assert as_dict(merged) == {("a", 1): (3, 3), ("b", 1): (4, 5)}


def test_a_partition_is_replaced_also_by_nothing(spark, tmp_path):
    path = str(tmp_path / "site")
    whole = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 2, 2)], SITE)
    for day in (date(2017, 1, 1), date(2017, 1, 2)):
        replace_partition(whole, path, dt=day, part="day")
    replace_partition(whole.where("site = 'b'"), path, dt=date(2017, 1, 2), part="day")
    replace_partition(whole.limit(0), path, dt=date(2017, 1, 1), part="day")
    replace_partition(whole.limit(0), path, dt=date(2017, 1, 3), part="day")
    assert as_dict(spark.read.parquet(path)) == {("b", 1): (2, 2)}


def test_a_table_of_empty_days_can_be_read(spark, tmp_path):
    path = str(tmp_path / "none")
    replace_partition(spark.createDataFrame([], SITE), path, dt=date(2017, 1, 1))
    assert spark.read.parquet(path).columns == ["site", "created", "uv", "pv", "dt"]
    assert spark.read.parquet(path).count() == 0
