"""Searchable archives, observed rejects, VARIANT payloads and heavy hitters."""

import random
from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidegauge.operators import heavy_hitters
from tidegauge.operators.heavy_hitters import missed_at_most, sketches, slots_of, top_keys_bounded
from tidegauge.operators.metrics import count_by, top_keys
from tidegauge.sources import app_events
from tidegauge.sources.app_events import REASONS, parse_behaviour, parse_behaviour_variant, parse_events, parse_events_observed
from tidegauge.sources.searchable import grep, write_searchable
from tidegauge.streaming import jobs, sinks, sources

LINES = [
    '{"mtime":"1484000000000","action":"a"}', '{"mtime":1484000000000,"action":"b"}', '{"mtime":"","action":"c"}', '{"mtime":"soon"}',
    '{"action":"d"}', "junk", "", None, '{"mtime":"99999999999999999999"}', '{"mtime":"99999999999999999"}', '{"mtime":null}',
    '{"mtime":"1484000000001"}', "[1]", '{"mtime":" 1484000000002"}', '{"mtime":"1484000000003","x":{"y":[1,"z"]}}',
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_observed_rejects_equal_a_count_of_them(spark, tmp_path):
    seen = Observation()
    events = parse_events_observed(lines(spark), seen)
    events.write.parquet(str(tmp_path / "out"))
    got = seen.get
    assert got["lines"] == len(LINES) and got["kept"] == spark.read.parquet(str(tmp_path / "out")).count()
    assert got["kept"] == parse_events(lines(spark)).count()
    rejects = {r["reason"]: r["num"] for r in app_events.count_rejects(lines(spark)).collect()}
    assert {REASONS[name]: got[name] for name in REASONS if got[name]} == rejects
    assert got["lines"] == got["kept"] + sum(got[name] for name in REASONS)


def test_rejects_are_counted_in_one_scan(spark, tmp_path):
    lines(spark).where("value is not null").write.text(str(tmp_path / "in"))
    events = parse_events_observed(spark.read.text(str(tmp_path / "in")), "rejects")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


def test_stream_stores_rejects_of_each_batch_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, part in enumerate((LINES[:6], LINES[8:], ["junk"])):
        (folder / f"{k}.json").write_text("\n".join(part) + "\n")
    sink = jobs.counted_event_sink(str(tmp_path / "events"), str(tmp_path / "rejects"))
    for _ in range(2):  # the second run finds nothing new
        jobs.run(sources.file_lines(spark, str(folder), max_files=1), sink, str(tmp_path / "checkpoint"))
    got = {r["reason"]: r["num"] for r in sinks.read_sums(spark, str(tmp_path / "rejects"), ["reason"]).collect()}
    assert got["lines"] == 6 + 7 + 1 and got["kept"] == spark.read.parquet(str(tmp_path / "events")).count()
    batches = spark.read.parquet(str(tmp_path / "rejects")).select("batch").distinct().count()
    assert batches == 3


def test_variant_payloads(spark, tmp_path):
    good = [x for x in LINES if x is not None] + ['{"mtime":"1484000000009","a":1,"a":2}']
    df = spark.createDataFrame([(x,) for x in good], "value string")
    rows = parse_behaviour_variant(df)
    rows.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert dict(stored.dtypes)["payload"] == "variant"
    as_text = parse_behaviour(lines(spark)).count()
    assert stored.count() == as_text  # the repeated key is bad JSON for VARIANT
    deep = stored.where("mtime = 1484000000003").select(F.try_variant_get("payload", "$.x.y[1]", "string")).first()[0]
    assert deep == "z"
    bad = spark.createDataFrame([("{",), (None,), ("nul",)], "value string")
    assert parse_behaviour_variant(bad).count() == 0 and parse_behaviour_variant(bad.limit(0)).count() == 0


def scanned(df):
    """Rows that the scan hands on, after row groups have been left out; and the result."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value(), rows


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("search"))
    rows = spark.range(60_000).select(
        F.concat(F.lit("m"), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("member_id"),
        F.when(F.col("id") % 3 == 0, "view").otherwise("click").alias("action"),
        F.timestamp_seconds(1_704_067_200 + F.col("id")).alias("ts"),
        F.when(F.col("id") % 2 == 0, date(2024, 1, 1)).otherwise(date(2024, 1, 2)).alias("dt"),
        F.repeat(F.md5(F.col("id").cast("string")), 4).alias("payload"),
    )
    busy = rows.withColumn("member_id", F.when(F.col("ts") > "2024-01-01 12:00:00", "busy").otherwise(F.col("member_id")))
    for name, df in (("plain", rows), ("busy", busy)):
        write_searchable(df, f"{root}/{name}", "dt", row_group_bytes=64 << 10, members=2000, files=16)
    # In order of time, each row group holds members of all ranges.
    unsorted = rows.orderBy("ts").drop("dt")
    for name, bloom in (("bloom", "true"), ("none", "false")):
        writer = unsorted.write.option("parquet.block.size", 64 << 10).option("parquet.enable.dictionary", "false")
        writer.option("parquet.bloom.filter.enabled#member_id", bloom).parquet(f"{root}/{name}")
    return root


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_row_groups_are_skipped(spark, archive, plain_plans):
    whole = spark.read.parquet(f"{archive}/plain")
    member = whole.groupBy("member_id").count().orderBy(F.desc("count"), "member_id").first()["member_id"]
    read, rows = scanned(grep(spark, f"{archive}/plain", [member], ["click"]))
    expected = whole.where((F.col("member_id") == member) & (F.col("action") == "click"))
    assert sorted(map(str, rows)) == sorted(map(str, expected.collect())) and rows
    assert read < 60_000 / 4
    read, rows = scanned(grep(spark, f"{archive}/plain", [member], first=date(2024, 1, 2), last=date(2024, 1, 2)))
    assert all(r["dt"] == date(2024, 1, 2) for r in rows)
    matching = grep(spark, f"{archive}/plain", [member], matching=F.col("payload").startswith("0"))
    assert matching.count() == whole.where((F.col("member_id") == member) & F.col("payload").startswith("0")).count()


def test_bloom_filters_skip_what_ranges_cannot(spark, archive, plain_plans):
    absent = "m5x"  # within the range of every row group
    with_filters, rows = scanned(grep(spark, f"{archive}/bloom", [absent]))
    without, none = scanned(grep(spark, f"{archive}/none", [absent]))
    assert rows == none == [] and with_filters < without / 2


def test_busy_member_is_split_over_files(spark, archive):
    files = spark.read.parquet(f"{archive}/busy").where("member_id = 'busy'").select(F.input_file_name()).distinct().count()
    assert files > 2


def zipf(spark, rows=20_000, kinds=5000, flat=0):
    draw = random.Random(4)
    weights = [1 / (k + 1 + flat) for k in range(kinds)]
    keys = draw.choices(range(kinds), weights, k=rows)
    return spark.createDataFrame([(str(k), k % 3, i % 4) for i, k in enumerate(keys)], "a string, b int, day int")


@pytest.mark.parametrize("flat", [0, 10**6])
@pytest.mark.parametrize("stored", [True, False])
def test_top_keys_equal_a_full_count(spark, flat, stored):
    """Skewed data are settled by the sketch; flat data by the exact way."""
    df = zipf(spark, flat=flat)
    parts = sketches(df, ["a", "b"], "day", tracked=400) if stored else None
    got = top_keys_bounded(df, 8, "a", "b", parts=parts, tracked=400).collect()
    assert got == top_keys(count_by(df, "a", "b"), 8, "a", "b").collect()


def test_what_the_sketch_misses_is_bounded(spark):
    df = zipf(spark)
    whole = heavy_hitters.combined(sketches(df, ["a", "b"], "day", tracked=400), tracked=400)
    sure = {r["_hash"] for r in heavy_hitters.candidates(whole, 400).collect()}
    counts = count_by(df.withColumn("h", heavy_hitters.key_hash(["a", "b"])), "h").collect()
    bound = missed_at_most(df.count(), 400)
    assert sure and len(sure) <= 400
    assert all(r["h"] in sure for r in counts if r["num"] > bound)
    assert slots_of(400) == 1024 and slots_of(10_000) == 16_384


def test_clear_leaders_need_no_full_count(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(heavy_hitters, "count_by", lambda df, *keys: calls.append(df) or count_by(df, *keys))
    assert len(top_keys_bounded(zipf(spark), 5, "a", "b", tracked=400).collect()) == 5
    assert len(calls) == 1  # of the candidates alone
    empty = zipf(spark).limit(0)
    assert top_keys_bounded(empty, 5, "a", "b", tracked=400).count() == 0
