"""Streams with state: rows before and after their session, restarts, and how much state there is."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidegauge.streaming import jobs, sinks
from tidegauge.streaming.sources import table_stream
from tidegauge.streaming.stateful import running_visitors, with_session_stream

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SESSION = "session string, since timestamp, until timestamp, member_id string"


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


class World:
    """Two folders of files that streams read one file at a time, and a run that takes what there is."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.add(logs=[], sessions=[])

    def add(self, logs=None, sessions=None):
        for name, rows, schema in (("log", logs, "id int, session string, ts timestamp"), ("held", sessions, SESSION)):
            if rows is not None:
                self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def run(self):
        log, held = (table_stream(self.spark, f"{self.root}/{n}/", max_files=1) for n in ("log", "held"))
        known = with_session_stream(log, held, "2 hours", "10 hours", ["member_id"])
        jobs.run(known, sinks.append_batch(f"{self.root}/out"), f"{self.root}/checkpoint")
        rows = self.spark.read.parquet(f"{self.root}/out").where("id >= 0").collect()
        assert len({r["id"] for r in rows}) == len(rows)
        return {r["id"]: r["member_id"] for r in rows}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, str(tmp_path))


def row(n, key, hours):
    return n, key, at(hours)


def session(key, since, until, member):
    return key, at(since), at(until), member


def test_early_and_late_sessions_over_batches_and_restarts(world):
    world.add([row(1, "a", 1), row(2, "b", 1)], [session("a", 0, None, "A")])
    assert world.run()[1] == "A"
    # The session of row 2 comes a run later than the row, which waits in the state for it.
    world.add([row(3, "a", 2), row(4, None, 2)], [session("b", 0.5, 3, "B")])
    got = world.run()
    assert got[2] == "B" and got[3] == "A" and 4 not in got
    # The time of row 5 is after the end of its session, that of row 6 past the longest life.
    world.add([row(5, "b", 3), row(6, "a", 10), row(7, "c", 9.5)], [session("c", 9.5, None, "C"), session("c", 20, None, "C2")])
    got = world.run()
    assert got[7] == "C" and got.get(5) is None and got.get(6) is None
    world.add([row(-1, "end", 100)], [session("end", 100, None, "x")])
    world.run()
    world.add([row(-2, "end", 101)], [session("end2", 101, None, "x")])
    got = world.run()
    assert got == {1: "A", 2: "B", 3: "A", 4: None, 5: None, 6: None, 7: "C"}
    # A run with nothing new changes nothing.
    assert world.run() == got


def test_state_ends_with_time(world, spark):
    for k in range(6):
        base = 12 * k
        world.add([row(10 * k + i, f"t{k}", base + i / 10) for i in range(5)], [session(f"t{k}", base, None, str(k))])
    log, held = (table_stream(spark, f"{world.root}/{n}/", max_files=1) for n in ("log", "held"))
    known = with_session_stream(log, held, "2 hours", "10 hours", ["member_id"])
    query = jobs.start(known, sinks.append_batch(f"{world.root}/out"), f"{world.root}/checkpoint")
    query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert len(states) >= 5 and max(states) <= 3 * 12  # of 36 rows, a few files' worth at a time


def visits(spark, path, parts):
    for rows in parts:
        spark.createDataFrame(rows, "ts timestamp, member_id string").coalesce(1).write.mode("append").parquet(path)
    return table_stream(spark, f"{path}/", max_files=1)


@pytest.mark.parametrize("splits", [1, 4])
def test_running_visitors(spark, tmp_path, splits):
    """A hot member in every hour; the counts are the batch counts, and the state is bounded."""
    parts = []
    for k in range(5):
        rows = [(at(2 * k + i / 200), "hot") for i in range(300)]
        rows += [(at(2 * k + i / 10), f"m{i % 7}") for i in range(15)] + [(at(2 * k), None)]
        parts.append(rows)
    log = visits(spark, str(tmp_path / "in"), [*parts, [(at(1000), "end")]])
    counted = running_visitors(log, "1 hour", splits=splits)
    query = jobs.start(counted, sinks.append_batch(str(tmp_path / "out"), "dt"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    got = {r["created"]: r["num"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    flat = spark.createDataFrame([r for p in parts for r in p], "ts timestamp, member_id string")
    hour = F.unix_timestamp(F.date_trunc("hour", "ts")).alias("created")
    expected = flat.groupBy(hour).agg(F.countDistinct("member_id").alias("num")).collect()
    assert got == {r["created"]: r["num"] for r in expected}
    operators = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    keys = 4 * 8  # hours that a state may hold, times members
    for states in operators:
        totals = sorted(s["numRowsTotal"] for s in states)
        assert len(totals) == (2 if splits == 1 else 3)
        assert totals[-1] <= keys * splits  # the shares, if any
        assert totals[0] <= 4  # windows
    # A restart adds nothing.
    jobs.run(running_visitors(table_stream(spark, f"{tmp_path}/in/", max_files=1), "1 hour", splits=splits),
             sinks.append_batch(str(tmp_path / "out"), "dt"), str(tmp_path / "checkpoint"))
    assert {r["created"]: r["num"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == got
