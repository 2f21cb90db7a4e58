import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import intervals
from tidegauge.operators.cohort import keep_paid_at
from tidegauge.operators.intervals import covering, keep_covered, level_of, levels_in_use, listed, merged, probed
from tidegauge.plans import temporal

DAY = datetime(2024, 1, 1)


def at(micros):
    return None if micros is None else DAY + timedelta(microseconds=micros)


def tables(spark, facts, spans):
    left = spark.createDataFrame([(n, k, at(t)) for n, k, t in facts], "n int, k string, ts timestamp")
    right = spark.createDataFrame(
        [(k, at(a), at(b), v) for k, a, b, v in spans], "k string, start timestamp, end timestamp, v int"
    )
    return left, right


def inside(t, a, b):
    return t is not None and (a is None or a <= t) and (b is None or t <= b) and not (a is not None and b is not None and a > b)


def plain(facts, spans):
    return Counter((n, v) for n, k, t in facts for key, a, b, v in spans if k is not None and k == key and inside(t, a, b))


SPANS = [
    ("a", 0, 10, 1), ("a", 10, 10, 2), ("a", 5, 3, 3), ("a", None, 4, 4), ("a", 8, None, 5), ("b", None, None, 6), (None, 0, 9, 7),
    ("a", 0, 10, 1), ("c", 0, 86_400_000_000, 8), ("c", 1, 2_592_000_000_000, 9),
]
FACTS = [(i, k, t) for i, (k, t) in enumerate(
    [("a", -1), ("a", 0), ("a", 4), ("a", 5), ("a", 10), ("a", 11), ("b", -5), ("b", 10**12), (None, 3), ("a", None), ("c", 0),
     ("c", 86_400_000_000), ("c", 86_400_000_001), ("c", 2_592_000_000_001), ("d", 1)]
)]


def test_edges_to_the_microsecond(spark):
    left, right = tables(spark, FACTS, SPANS)
    got = Counter((r["n"], r["v"]) for r in covering(left, right, ["k"]).collect())
    assert got == plain(FACTS, SPANS)
    kept = sorted(r["n"] for r in keep_covered(left, right, ["k"]).collect())
    assert kept == sorted({n for n, _ in plain(FACTS, SPANS)})
    assert covering(left, right.limit(0), ["k"]).count() == 0 and covering(left.limit(0), right, ["k"]).count() == 0


@pytest.mark.parametrize("scale", [1, 10**6, 10**9])
def test_random_spans(spark, scale):
    draw = random.Random(scale)
    spans, facts = [], [(i, f"k{draw.randrange(4)}", draw.randrange(2000) * scale) for i in range(400)]
    for i in range(300):
        a = draw.choice([None] + [draw.randrange(2000) * scale] * 20)
        b = draw.choice([None] + [(a or 0) + int(draw.expovariate(1 / 60)) * scale] * 20)
        spans.append((f"k{draw.randrange(5)}", a, b, i))
    left, right = tables(spark, facts, spans)
    assert Counter((r["n"], r["v"]) for r in covering(left, right, ["k"]).collect()) == plain(facts, spans)
    kept = sorted(r["n"] for r in keep_covered(left, right, ["k"]).collect())
    assert kept == sorted({n for n, _ in plain(facts, spans)})


def test_merged_intervals_are_disjoint(spark):
    _, right = tables(spark, [], SPANS)
    got = sorted((r["k"], r["start"] and (r["start"] - DAY) // timedelta(microseconds=1), r["end"] and (r["end"] - DAY) // timedelta(microseconds=1))
                 for r in merged(right, ["k"]).collect() if r["k"] != "a")
    assert got == [("b", None, None), ("c", 0, 2_592_000_000_000)]
    whole = [r for r in merged(right, ["k"]).collect() if r["k"] == "a"]
    assert [(r["start"], r["end"]) for r in whole] == [(None, None)]


def test_rows_met_per_fact_are_bounded(spark):
    """Ten thousand overlapping payments of one enterprise: a request meets few intervals."""
    pays = spark.range(10_000).select(
        F.lit("org").alias("instance_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("start"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60 + F.when(F.col("id") % 7 < 3, 50).otherwise(40_000)).alias("end"),
        F.lit(1.0).alias("total_fee"),
    )
    facts = spark.range(2000).select(
        F.lit("org").alias("instance_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 311).alias("ts"), "id"
    )
    bins = listed(merged(pays, ["instance_id"]))
    met = probed(facts, "ts", levels_in_use(bins)).join(bins, ["instance_id", "_level", "_bin"])
    assert met.groupBy("id").count().agg(F.max("count")).first()[0] <= 2 * intervals.STEP
    assert keep_paid_at(facts, pays).count() == facts.join(
        pays, (facts.ts >= pays.start) & (facts.ts <= pays.end), "left_semi"
    ).count()


def test_levels_follow_lengths(spark):
    lengths = [1, 2, 8, 9, 64, 65, 10**6, 10**12, 9 * 10**18 // 10]
    df = spark.createDataFrame([(0, n) for n in lengths], "a long, n long")
    levels = [r[0] for r in df.select(level_of(F.col("a"), F.col("n") - 1)).collect()]
    assert all(n <= intervals.STEP**k and (k == 0 or n > intervals.STEP ** (k - 1)) for n, k in zip(lengths, levels))


def test_plan_joins_by_equality(spark):
    left, right = tables(spark, FACTS, SPANS)
    plan = covering(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "_bin" in plan


@pytest.mark.parametrize("scale", [0, 1, 10**6, 10**9, 10**12])
def test_counts_agree_with_pairs(spark, scale):
    """Also of ends on the bins' edges, open ends, single instants, times before 1970 and repeated rows."""
    draw = random.Random(scale)
    facts, spans = FACTS, SPANS
    if scale:
        step = scale * 8**3 // 10**2 + 1
        facts = [(i, f"k{draw.randrange(3)}", draw.randrange(-500, 1500) * step) for i in range(300)]
        spans = []
        for i in range(250):
            a = draw.choice([None] + [draw.randrange(-500, 1500) * step] * 12)
            b = draw.choice([None] + [(a or 0) + int(draw.expovariate(1 / 40)) * step] * 12)
            spans += [(f"k{draw.randrange(4)}", a, b, i)] * draw.choice([1, 1, 2])
        spans += [("k1", t, t, 999) for _, k, t in facts if k == "k1"]
    left, right = tables(spark, facts, spans)
    left = left.withColumnRenamed("n", "id")
    met = covering(left, right, ["k"], how="count", value="v")
    assert met.columns == ["id", "k", "ts", "n", "highest"]
    got = {r["id"]: (r["n"], r["h"]) for r in met.groupBy("id").agg(F.sum("n").alias("n"), F.max("highest").alias("h")).collect()}
    pairs = plain(facts, spans)
    wanted = {}
    for (i, v), times in pairs.items():
        n, highest = wanted.get(i, (0, v))
        wanted[i] = n + times, max(highest, v)
    assert got == wanted and (scale or len(wanted) > 5)
    assert covering(left, right.limit(0), ["k"], how="count", value="v").count() == 0


def test_counting_makes_no_pairs(spark, sf):
    """A busy enterprise's requests and payments are counted, not paired."""
    plan = temporal.payments_at_instant(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    joined = [x for x in plan.splitlines() if "Join Inner" in x]
    # Only the slices that have facts meet the bins around them.
    assert len(joined) == 1 and "_slice" not in joined[0] and "event_id" not in joined[0]
    assert "Window" in plan
