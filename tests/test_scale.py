"""Plans: what must hold on a cluster can be read off them on a laptop."""

import re

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.joins import lookup
from tidegauge.plans.queries import QUERIES
from tidegauge.session import shared_dir, shuffle_partitions

STREAMS = [name for name in QUERIES if "stream" in name]
BATCH = [name for name in QUERIES if name not in STREAMS]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Sets session values for one test."""
    old = {}

    def set_(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", BATCH)
def test_plans_have_no_pairwise_join_and_no_python(spark, sf, conf, name):
    # Tables other tests cached were planned with broadcasts.
    spark.catalog.clearCache()
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("NestedLoop", "Cartesian", "Python", "InPandas", "CollectLimit"):
        assert bad not in plan
    # Only tables of a fixed size are broadcast when the data is too big for it.
    for build in re.findall(r"Join .*Build(?:Left|Right)", plan):
        assert re.search(r"nationkey|regionkey|_group", build), build


def skewed(spark, rows=200_000):
    """Two thirds of the rows have one key, a tenth have none."""
    key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    facts = spark.range(rows).select("id", F.when(F.col("id") % 10 > 0, key).alias("k"))
    dim = spark.range(0, rows, 3).select(
        F.col("id").cast("string").alias("k"), F.col("id").alias("v")
    )
    hot = spark.createDataFrame([("hot", -1)], "k string, v bigint")
    return facts, dim.unionByName(hot)


def test_hot_key_of_a_lookup_is_split_at_run_time(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    facts, dim = skewed(spark)
    joined = lookup(facts.repartition(8), dim, "k", "v")
    got = joined.agg(
        F.count("*"), F.count_if(F.col("v") == -1), F.count_if(F.col("v").isNull())
    )
    total, hot, none = got.collect()[0]
    ids = range(200_000)
    assert total == 200_000
    assert hot == sum(1 for i in ids if i % 10 and i % 3)
    assert none == sum(1 for i in ids if i % 10 == 0)
    assert "skew=true" in plan_of(got)


def test_rows_without_a_key_are_spread(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    nobody = F.when(F.col("id") < 0, "a").alias("k")
    facts = spark.range(8000).select("id", nobody)
    dim = spark.createDataFrame([("a", 1)], "k string, v int")
    sizes = lookup(facts, dim, "k", "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 2000


def test_only_needed_columns_are_read(spark, sf):
    scan = re.search(r"ReadSchema: (struct<.*?>)", plan_of(QUERIES["ipv_hour"](spark, sf)))
    assert "value" not in scan.group(1) and "event_id" not in scan.group(1)


def test_time_ranges_reach_the_scan(spark, sf):
    for name in ("scan_day_range", "scan_last_hour"):
        pushed = re.search(r"PushedFilters: \[(.*?)\]", plan_of(QUERIES[name](spark, sf)))
        assert "GreaterThanOrEqual(ts" in pushed.group(1) and "LessThan(ts" in pushed.group(1)


def test_rows_are_folded_before_the_shuffle(spark, sf):
    """Below the first exchange over the log there is a partial aggregate, and no join."""
    plan = plan_of(QUERIES["uv_day"](spark, sf))
    first = plan[plan.index("Join") :]
    log = first[: first.index("FileScan")]
    assert "partial_count" in log or "HashAggregate" in log


def test_shared_folder_is_the_cluster_setting(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{parent}/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 << 40) == 81920


def test_unique_dimension_needs_one_shuffle_less(spark):
    facts = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folded, plain = (lookup(facts, dim, "k", "v", unique=u) for u in (False, True))
        plans = [df._jdf.queryExecution().executedPlan().toString().count("Exchange") for df in (folded, plain)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[1] < plans[0]
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, plain.collect()))
