import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.asof_join import as_of_join
from tidegauge.plans import adapters
from tidegauge.plans.temporal import identity_as_of

DAY = datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else DAY + timedelta(seconds=seconds)


def plain(facts, history, ended):
    """The history row with the latest start, looked up fact by fact."""
    out = []
    for n, key, t in facts:
        begun = [(s, e, v) for k, s, e, v in history if k == key and key is not None and s is not None and t is not None and s <= t]
        best = max(begun, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]), default=None)
        gone = ended and best is not None and best[1] is not None and best[1] <= t
        out.append((n, key, None if best is None or gone else best[2]))
    return sorted(out, key=lambda r: r[0])


def joined(spark, facts, history, ended, **settings):
    left = spark.createDataFrame([(n, k, at(t)) for n, k, t in facts], "n int, k string, ts timestamp")
    right = spark.createDataFrame(
        [(k, at(s), at(e), v) for k, s, e, v in history], "k string, since timestamp, until timestamp, v string"
    )
    found = as_of_join(left, right, "k", ["v"], until="until" if ended else None, **settings)
    assert found.columns == ["n", "k", "ts", "v"]
    return sorted([(r["n"], r["k"], r["v"]) for r in found.collect()])


CASES = [
    [("a", 0, None, "a0"), ("a", 100, 150, "a1"), ("a", 100, 150, "a2"), ("b", 50, 50, "b0"), (None, 0, None, "x"), ("c", None, None, "y")],
    [],
]


@pytest.mark.parametrize("history", CASES)
@pytest.mark.parametrize("ended", [True, False])
def test_edges(spark, history, ended):
    facts = [(i, k, t) for i, (k, t) in enumerate(
        [("a", -1), ("a", 0), ("a", 99), ("a", 100), ("a", 149), ("a", 150), ("a", 90_000), ("b", 50), ("b", 51),
         ("c", 5), (None, 5), ("a", None), (None, None), ("d", 1), ("a", 100)]
    )]
    assert joined(spark, facts, history, ended) == plain(facts, history, ended)
    assert joined(spark, [], history, ended) == []


@pytest.mark.parametrize("slice_seconds,group_rows", [(60, 7), (1000, 10_000), (10**7, 20)])
def test_one_token_on_half_of_the_rows(spark, slice_seconds, group_rows):
    draw = random.Random(slice_seconds)
    facts = [(i, "hot" if draw.random() < 0.5 else f"k{draw.randrange(30)}", draw.randrange(5000)) for i in range(2000)]
    history = []
    for k in ["hot", *(f"k{i}" for i in range(20))]:
        for g in range(draw.randrange(1, 12)):
            s = draw.randrange(5000)
            history.append((k, s, draw.choice([None, s + draw.randrange(600)]), f"{k}-{g}"))
    got = joined(spark, facts, history, True, slice_seconds=slice_seconds, group_rows=group_rows)
    assert got == plain(facts, history, True)


def test_hot_token_is_dealt_out(spark):
    facts = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 3000).alias("ts"), "id"
    )
    history = spark.createDataFrame([("hot", DAY, "v")], "k string, since timestamp, v string")
    found = as_of_join(facts, history, "k", ["v"], group_rows=2000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for n in found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 15_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_range_join(spark, sf):
    plan = plan_of(identity_as_of(spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Window" in plan


def test_clashing_names_and_values(spark):
    facts = spark.createDataFrame([("a", DAY, 1, 2)], "k string, ts timestamp, row int, n int")
    history = spark.createDataFrame([("a", DAY, 9, "x")], "k string, since timestamp, shares int, until_ string")
    row = as_of_join(facts, history, "k", ["shares", "until_"]).first()
    assert tuple(row) == ("a", DAY, 1, 2, 9, "x")


@pytest.mark.parametrize("history,of_each", [(adapters.session_history, 8), (adapters.geo_history, 28)])
def test_generated_histories_are_not_broadcast(spark, history, of_each):
    people = spark.createDataFrame(
        [(k, "3", "AUTOMOBILE", 1.0, 3, "PERU", "AMERICA") for k in (1, 2, 2)],
        "custkey long, org string, segment string, balance double, nationkey int, country string, region string",
    )
    made = history(people)
    assert "Broadcast" not in plan_of(made)
    # A key that comes twice meets both of its own rows.
    assert made.count() == of_each * (1 + 2 * 2)
