"""Streams over files: the result is the batch result, and nothing counts twice."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_sources import line

from tidegauge.operators.filters import not_openapi
from tidegauge.operators.metrics import count_by
from tidegauge.plans import adapters
from tidegauge.plans.queries import QUERIES, region_views
from tidegauge.sources.archive import with_partitions
from tidegauge.streaming import jobs, sinks, sources


def promo_line(r, day="07", site="m"):
    return line(
        site=site,
        request=f"GET /p.htm?r={r} HTTP/1.1",
        time_local=f"[{day}/Jan/2017:10:00:00 +0000]",
    )


@pytest.fixture
def folder(tmp_path):
    """Writes files a text stream finds; returns the folder and the writer."""
    path = tmp_path / "in"
    path.mkdir()

    def add(name, *lines):
        (path / name).write_text("\n".join(lines) + "\n")

    return str(path), add


def promo(spark, folder, tmp_path):
    stream = sources.file_lines(spark, folder, max_files=1)
    sink = sinks.aggregated(jobs.promo_counts, sinks.append_batch(str(tmp_path / "out"), "day"))
    jobs.run(stream, sink, str(tmp_path / "checkpoint"))
    summed = sinks.read_sums(spark, str(tmp_path / "out"), ["day", "site", "r"])
    return {(str(r["day"]), r["site"], r["r"]): r["num"] for r in summed.collect()}


def test_promo_counters_add_up_over_batches_and_restarts(spark, folder, tmp_path):
    path, add = folder
    add("1.log", promo_line("a"), promo_line("a"), promo_line(""), "junk")
    add("2.log", promo_line("a"), promo_line("b", site="esn"))
    expected = {("20170107", "m", "a"): 3, ("20170107", "esn", "b"): 1}
    assert promo(spark, path, tmp_path) == expected
    # A restart from the checkpoint has nothing to do.
    assert promo(spark, path, tmp_path) == expected
    # A late event adds to the row of its own day.
    add("3.log", promo_line("a", day="01"), promo_line("b", site="esn"))
    expected |= {("20170101", "m", "a"): 1, ("20170107", "esn", "b"): 2}
    assert promo(spark, path, tmp_path) == expected


def test_replayed_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "out")
    batch = spark.createDataFrame([("x", 2), ("y", 1)], "k string, num bigint")
    sink = sinks.append_batch(path)
    sink(batch, 0)
    sink(batch, 1)
    sink(batch, 1)
    got = {r["k"]: r["num"] for r in sinks.read_sums(spark, path, ["k"]).collect()}
    assert got == {"x": 4, "y": 2}


def test_many_batches_equal_one_batch_run(spark, sf, tmp_path):
    """The log in five files, a file per batch, against the batch queries over all of it."""
    events = spark.read.parquet(f"{sf}/events.parquet").orderBy("value")
    events.repartition(5).write.parquet(str(tmp_path / "events"))
    log = adapters.as_hits(sources.table_stream(spark, str(tmp_path / "events"), max_files=1))
    log = log.where(not_openapi())

    keys = str(tmp_path / "keys")
    fresh = jobs.first_seen(jobs.visitors(log), "400 days", "created", "member_id").drop("ts")
    jobs.run(fresh, sinks.append_batch(keys, "dt"), str(tmp_path / "checkpoint-keys"))
    stored = spark.read.parquet(keys)
    assert stored.select("batch").distinct().count() >= 5
    assert stored.count() == stored.select("created", "member_id").distinct().count()
    counted = {r["created"]: r["num"] for r in count_by(stored, "created").collect()}
    whole = QUERIES["uv_day_hour_union"](spark, sf).where("type = '1hour'").collect()
    assert counted == {r["created"]: r["num"] for r in whole}

    views = str(tmp_path / "views")
    users = adapters.located_users(spark, sf)

    sink = sinks.aggregated(
        lambda batch: region_views(batch, users), sinks.append_batch(views)
    )
    jobs.run(log, sink, str(tmp_path / "checkpoint-views"))
    summed = sinks.read_sums(spark, views, ["created", "region"]).collect()
    batch = QUERIES["pv_second_region"](spark, sf).collect()
    assert sorted(map(tuple, summed)) == sorted(map(tuple, batch))


def test_two_outputs_see_one_batch(spark, tmp_path):
    seen = []
    sink = sinks.both(
        lambda batch, i: seen.append(("log", batch.count(), batch.storageLevel.useMemory)),
        lambda batch, i: seen.append(("sum", batch.count(), batch.storageLevel.useMemory)),
    )
    sink(spark.range(5), 0)
    assert seen == [("log", 5, True), ("sum", 5, True)]


def test_running_word_count(spark, folder, tmp_path):
    path, add = folder
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    add("1.txt", "a b a", "c")
    add("2.txt", "a  d")

    def run():
        words = jobs.word_counts("value", sources.file_lines(spark, path, max_files=1))
        jobs.run(words, sinks.append_batch(out), checkpoint, mode="update")
        return {r["word"]: r["num"] for r in sinks.read_latest(spark, out, ["word"]).collect()}

    assert run() == {"a": 3, "b": 1, "c": 1, "d": 1}
    add("3.txt", "a b")
    assert run() == {"a": 4, "b": 2, "c": 1, "d": 1}


def timed(spark, path):
    rows = spark.readStream.schema("s bigint, region_code string").json(path)
    return rows.withColumn("ts", F.timestamp_seconds("s"))


def test_windowed_page_views_are_final_after_the_delay(spark, folder, tmp_path):
    path, add = folder
    out = str(tmp_path / "out")
    add("1.json", *[json.dumps({"s": s, "region_code": "x"}) for s in (1, 1, 2)])
    views = jobs.windowed_page_views(timed(spark, path), "10 seconds")

    def run():
        jobs.run(views, sinks.append_batch(out), str(tmp_path / "checkpoint"))

    run()
    # Far enough ahead to close the first seconds; the event of second 1 is too late by then.
    add("2.json", json.dumps({"s": 100, "region_code": "x"}))
    run()
    add("3.json", json.dumps({"s": 1, "region_code": "x"}))
    run()
    got = {r["created"]: r["num"] for r in spark.read.parquet(out).collect()}
    assert got == {1: 2, 2: 1}


def test_first_seen_keeps_one_row_per_key(spark, folder, tmp_path):
    path, add = folder
    out = str(tmp_path / "out")
    add("1.json", *[json.dumps({"s": 1, "region_code": c}) for c in "xxy"])
    stream = jobs.first_seen(timed(spark, path), "10 seconds", "region_code")
    jobs.run(stream, sinks.append_batch(out), str(tmp_path / "checkpoint"))
    add("2.json", json.dumps({"s": 2, "region_code": "x"}))
    jobs.run(stream, sinks.append_batch(out), str(tmp_path / "checkpoint"))
    assert sorted(r["region_code"] for r in spark.read.parquet(out).collect()) == ["x", "y"]


def test_archive_of_a_stream_by_day_and_hour(spark, folder, tmp_path):
    path, add = folder
    out = str(tmp_path / "out")
    add("1.json", *[json.dumps({"s": s, "region_code": "x"}) for s in (0, 3600, 90000)])
    stream = with_partitions(timed(spark, path))
    for _ in range(2):
        jobs.run(stream, sinks.append_batch(out, "dt", "hr"), str(tmp_path / "checkpoint"))
    rows = spark.read.parquet(out).where(F.col("dt") == date(1970, 1, 1))
    assert sorted((r["s"], r["hr"]) for r in rows.collect()) == [(0, 0), (3600, 1)]


def test_closed_day_is_settled(spark, tmp_path):
    path, out = str(tmp_path / "parts"), str(tmp_path / "report")
    sink = sinks.append_batch(path, "day")
    for batch_id in range(3):
        rows = [("d1", "x", 1), ("d2", "x", 5)]
        sink(spark.createDataFrame(rows, "day string, r string, num int"), batch_id)
    for _ in range(2):
        sinks.settle_sums(spark, path, out, "day", "d1", ["r"])
    assert [(r["day"], r["r"], r["num"]) for r in spark.read.parquet(out).collect()] == [("d1", "x", 3)]


def test_settled_days_hold_few_files(spark, tmp_path):
    path = str(tmp_path / "log")
    sink = sinks.append_batch(path, "day")
    for batch_id in range(20):
        rows = [("d1", batch_id), ("d2", batch_id)]
        sink(spark.createDataFrame(rows, "day string, n int"), batch_id)
    before = sinks.read_settled(spark, path, "day")
    whole = sorted((r["day"], r["n"]) for r in before.collect())
    for _ in range(2):
        sinks.settle(spark, path, "day", "d1")
    after = sinks.read_settled(spark, path, "day")
    assert sorted((r["day"], r["n"]) for r in after.collect()) == whole
    assert len(after.where("day = 'd1'").inputFiles()) < len(before.inputFiles())
    assert spark.read.parquet(f"{path}-settled").count() == 20


def test_a_batch_sees_sessions_that_began_after_the_stream(spark, tmp_path):
    path = str(tmp_path / "sessions")
    kinds = "session string, member_id string, qz_id string, user_id string, instance_id string"
    spark.createDataFrame([("esn:a", "1", "1", "1", "1")], kinds).write.parquet(path)
    seen = []

    def dimensions(session):
        known = session.read.parquet(path)
        seen.append(known.count())
        geo = session.createDataFrame([], "ip string, country string, region string, city string")
        return geo, known.withColumns({"kind": F.lit("esn"), "token": F.substring("session", 5, 9)})

    out = str(tmp_path / "out")
    sink = jobs.access_sink(dimensions, f"{out}/log", f"{out}/views", partitions=("dt",))
    batch = spark.createDataFrame([(promo_line("a"),)], "value string")
    sink(batch, 0)
    spark.createDataFrame([("esn:b", "2", "2", "2", "2")], kinds).write.mode("append").parquet(path)
    sink(batch, 1)
    assert seen == [1, 2]


def test_starting_offsets():
    text = sources.starting_offsets("t", {0: 100, 1: 50, 2: 3}, {0: 90}, replay=5)
    assert json.loads(text) == {"t": {"0": 85, "1": 45, "2": 0}}


def test_kafka_options():
    options = sources.kafka_options("h:9092", "t", "earliest", 1000)
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "1000"
    assert "maxOffsetsPerTrigger" not in sources.kafka_options("h:9092", "t")


def test_dimensions_of_a_batch_are_made_by_all_tasks(spark, sf, monkeypatch):
    """The rows made of the customers' file are not sorted by the one task that reads it."""
    held = []

    class Held(Exception):
        pass

    def caught(dimensions, *paths, **settings):
        held.extend(dimensions(spark))
        raise Held

    monkeypatch.setattr(jobs, "access_sink", caught)
    with pytest.raises(Held):
        QUERIES["stream_access_log"](spark, sf)
    assert len(held) == 2
    for dim in held:
        sizes = [n for n in dim.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
        assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2
