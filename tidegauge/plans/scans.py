"""Queries that store a table as a job does and read it back by its scan, with their SQL."""

from __future__ import annotations

import json
from datetime import date, datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import asof
from tidegauge.functions.timebuckets import day_of, wall_clock
from tidegauge.operators import enrich, filters, key_sets
from tidegauge.plans import adapters as a
from tidegauge.plans import cascade
from tidegauge.plans import queries as q
from tidegauge.plans.oracles import FACTS, HITS, ORACLES, PROMO
from tidegauge.plans.oracles import LINES as LINE_ROWS
from tidegauge.session import shared_dir
from tidegauge.sources import access_log, archive
from tidegauge.streaming import jobs as stream_jobs
from tidegauge.streaming import sinks, sources

QUERIES = {}
SQL = {}

FIRST, LAST = date(2024, 1, 9), date(2024, 1, 11)
REPLAY, TOPIC = 25, "access"


def _query(sql: str, *tables: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = "WITH " + ",".join((HITS, *tables)) + sql
        return f

    return register


def newest(spark, sf) -> datetime:
    return q._events(spark, sf).agg(F.max("ts")).first()[0]


def _archived(spark, sf, purpose: str, rows: DataFrame) -> str:
    path = shared_dir(spark, purpose)
    archive.overwrite_partitions(rows.withColumn("dt", day_of("ts")), path, "dt")
    return path


@_query(
    """ SELECT event_id, site, ip FROM hits
    WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) - 1 FROM events)"""
)
def scan_yesterday(spark, sf):
    """The archive's rows of the day before the newest event's."""
    path = _archived(spark, sf, "log", a.hits(spark, sf).select("event_id", "ts", "site", "ip"))
    return archive.read_yesterday(spark, path, newest(spark, sf)).select("event_id", "site", "ip")


@_query(
    """ SELECT DISTINCT strftime(date_trunc('week', d), '%Y-%m-%d') AS period_start, member_id FROM facts
    WHERE date_trunc('week', d) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'""",
    FACTS,
)
def scan_periods(spark, sf):
    """Stored week sets of the weeks that two days fall into."""
    path = shared_dir(spark, "week_uv")
    keys = key_sets.period_keys(q._facts(spark, sf), "week", key_sets.KEY_SETS["uv"])
    archive.overwrite_partitions(keys, path, "period_start")
    found = archive.read_periods(spark, path, "week", date(2024, 1, 10), date(2024, 1, 18))
    return found.select(q._day_text("period_start"), "member_id")


@_query(
    """ SELECT event_id, event_type AS action, member_id FROM hits
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'"""
)
def scan_event_days(spark, sf):
    """App events of some days, from an archive by event day."""
    path = _archived(spark, sf, "events", q._app_events(spark, sf))
    found = archive.read_days(spark, path, FIRST, LAST)
    return found.select(F.col("ver_code").cast("bigint").alias("event_id"), "action", "member_id")


@_query(
    """ SELECT strftime(d, '%Y-%m-%d') AS day, member_id, instance_id FROM facts
    WHERE d BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'""",
    FACTS,
)
def scan_daily_facts(spark, sf):
    """Daily facts as the daily run stores them, each day twice, and read by day."""
    root = shared_dir(spark, "facts")
    log = a.with_org(a.hits(spark, sf), a.users(spark, sf))
    days = [date.fromordinal(FIRST.toordinal() + k) for k in range((LAST - FIRST).days + 1)]
    for day in (*days, days[0]):
        cascade.store_usage(spark, root, log, day)
    found = archive.read_days(spark, f"{root}/facts", FIRST, LAST, "day")
    return found.select(q._day_text("day"), "member_id", "instance_id")


SQL["stored_clicks"] = (
    f"SELECT app_id, client_ip, mtime, member_id FROM ({ORACLES['derive_clicks']})"
    " WHERE CAST(mtime AS BIGINT) >= epoch_ms(TIMESTAMP '2024-01-09')"
    " AND CAST(mtime AS BIGINT) < epoch_ms(TIMESTAMP '2024-01-11')"
)


def stored_clicks(spark, sf):
    """Clicks of two days as the daily run stores them, one day twice."""
    root = shared_dir(spark, "clicks")
    parsed = access_log.parse_lines(a.lines(spark, sf)).where(filters.not_openapi())
    known = enrich.with_identity(parsed, a.sessions(a.dealt(a.users(spark, sf))))
    log = known.where(filters.has_identity() & F.col("ts").isNotNull())
    for day in (FIRST, date(2024, 1, 10), FIRST):
        cascade.store_clicks(spark, root, log, day)
    return spark.read.parquet(f"{root}/events").select("app_id", "client_ip", "mtime", "member_id")


QUERIES["stored_clicks"] = stored_clicks


@_query(
    """, newest AS (SELECT max(ts) AS t FROM events)
    SELECT 'today' AS period, count(*) AS num FROM hits, newest WHERE date_trunc('day', ts) = date_trunc('day', t)
    UNION ALL SELECT 'yesterday', count(*) FROM hits, newest
      WHERE date_trunc('day', ts) = date_trunc('day', t) - INTERVAL 1 DAY
    UNION ALL SELECT 'last hour', count(*) FROM hits, newest
      WHERE date_trunc('hour', ts) = date_trunc('hour', t) - INTERVAL 1 HOUR
    UNION ALL SELECT 'this week', count(*) FROM hits, newest WHERE date_trunc('week', ts) = date_trunc('week', t)
    UNION ALL SELECT 'this month', count(*) FROM hits, newest WHERE date_trunc('month', ts) = date_trunc('month', t)"""
)
def default_periods(spark, sf):
    """Requests of each default period of a job, as of the newest event."""
    now = newest(spark, sf)
    today, ts = now.date(), F.col("ts")

    def since(day: date):
        return ts >= wall_clock(datetime.combine(day, time.min))

    yesterday = asof.yesterday(now)
    periods = {
        "today": since(today),
        "yesterday": archive.between_days("ts", yesterday, yesterday),
        "last hour": archive.in_hour("ts", asof.last_hour(now)),
        "this week": since(asof.week_start(today)),
        "this month": since(asof.month_start(today)),
    }
    counts = q._events(spark, sf).agg(*(F.count_if(c).alias(name) for name, c in periods.items()))
    return counts.unpivot([], list(periods), "period", "num")


@_query(
    """ SELECT event_id || '|' || site || '|' || ip || '|' || coalesce(member_id, '') AS line FROM hits"""
)
def text_dump(spark, sf):
    """Rows dumped as text, a file for each task, and read back."""
    path = shared_dir(spark, "dump")
    archive.write_text(a.hits(spark, sf).select("event_id", "site", "ip", "member_id"), path, "|")
    return spark.read.text(path).withColumnRenamed("value", "line")


@_query(PROMO, LINE_ROWS)
def text_stream(spark, sf):
    """Promotion counts of a folder of text files, read as a stream of a few files at a time."""
    path = shared_dir(spark, "lines")
    a.lines(spark, sf).repartition(6).write.text(path)
    stream = sources.file_lines(spark, path, max_files=2)
    out = q._run(
        spark,
        stream,
        "text",
        lambda p: sinks.aggregated(stream_jobs.promo_counts, sinks.append_batch(p, "day")),
    )
    summed = sinks.read_sums(spark, out, ["day", "site", "r"])
    return summed.withColumn("day", F.col("day").cast("string"))


@_query(
    f""" SELECT CAST(custkey % 4 AS INTEGER) AS part,
      CAST(greatest(coalesce(sum(CASE WHEN custkey % 4 <> 3 AND ts < TIMESTAMP '2024-01-16 12:00:00' THEN 1 END),
        count(*)) - {REPLAY}, 0) AS BIGINT) AS start FROM hits GROUP BY custkey % 4"""
)
def replay_offsets(spark, sf):
    """Where a first run starts: committed offsets, for a partition without one the latest, less a replay.

    A user's requests make up one of four partitions of the topic.
    """
    halves = q._halves()[0]
    parts = q._events(spark, sf).groupBy((F.col("user_id") % 4).cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("latest"), F.count_if(halves).alias("committed")
    )
    rows = parts.collect()  # one for each partition of the topic
    latest = {r["part"]: r["latest"] for r in rows}
    committed = {r["part"]: r["committed"] for r in rows if r["part"] != 3}
    start = json.loads(sources.starting_offsets(TOPIC, latest, committed, REPLAY))[TOPIC]
    offsets = F.from_json(F.lit(json.dumps(start)), "map<string, bigint>")
    found = parts.withColumn("start", F.element_at(offsets, F.col("part").cast("string")))
    return found.select("part", "start")
