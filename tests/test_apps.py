from pyspark.sql import functions as F

from tidegauge.operators import apps
from tidegauge.plans import adapters, jobs

REGISTRY = "rpid bigint, app_id string, open_appid string, name string"


def dimension(spark):
    rows = [("1", "0", "one"), ("2", "77", "two"), ("3", "", "three"), ("4", "7", "")]
    return spark.createDataFrame(rows, "app_id string, open_appid string, name string")


def test_normalize(spark):
    ids = ["1", "2", "3", "4", "5", "-9", "a+b", "", None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ids)], "i int, app_id string")
    got = {
        r["i"]: (r["open_appid"], r["app_id"], r["name"])
        for r in apps.normalize_apps(df, dimension(spark)).collect()
    }
    assert got == {
        0: ("0", "1", "one"),
        1: ("77", "0", "two"),
        5: ("-9", "0", "empty"),
        6: ("a+b", "0", "empty"),
    }


def pairs(spark, n, start=0):
    df = spark.range(start, start + n).select(F.col("id").cast("string").alias("app_id"))
    return df.withColumns({"open_appid": F.lit("0"), "name": F.concat(F.lit("n"), "app_id")})


def test_new_ids_are_dense_and_follow_the_largest(spark):
    registry = spark.createDataFrame([(41, "5", "0", "n5")], REGISTRY)
    full = apps.assign_app_ids(pairs(spark, 500), registry)
    ids = {r["app_id"]: r["rpid"] for r in full.collect()}
    assert ids["5"] == 41 and len(ids) == 500
    assert sorted(ids.values()) == list(range(41, 541))


def test_empty_registry_starts_at_one(spark):
    full = apps.assign_app_ids(pairs(spark, 3), spark.createDataFrame([], REGISTRY))
    assert sorted(r["rpid"] for r in full.collect()) == [1, 2, 3]


def test_ids_do_not_depend_on_partitioning(spark):
    registry = spark.createDataFrame([], REGISTRY)
    some = apps.assign_app_ids(pairs(spark, 200).repartition(7), registry).collect()
    other = apps.assign_app_ids(pairs(spark, 200).coalesce(1), registry).collect()
    assert sorted(some) == sorted(other)


def test_second_run_keeps_ids(spark, tmp_path):
    path = str(tmp_path / "registry")
    first = apps.assign_app_ids(pairs(spark, 20), spark.createDataFrame([], REGISTRY))
    first.write.parquet(path)
    second = apps.assign_app_ids(pairs(spark, 30), spark.read.parquet(path)).collect()
    before = {r["app_id"]: r["rpid"] for r in spark.read.parquet(path).collect()}
    after = {r["app_id"]: r["rpid"] for r in second}
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == list(range(1, 31))


def test_usage_reports_add_up(spark, sf):
    from tidegauge.sources.app_events import parse_events

    events = parse_events(adapters.app_events(spark, sf))
    dim, registry = adapters.apps(spark, sf), adapters.app_registry(spark, sf)
    _, reports = jobs.app_usage(events, dim, registry)
    total = apps.normalize_apps(events, dim).count()
    assert reports["app_action"].agg(F.sum("num")).first()[0] == total
    assert reports["app_space"].agg(F.sum("num")).first()[0] == total
    known = reports["app_enterprise"].agg(F.sum("num")).first()[0]
    assert 0 < known < total
