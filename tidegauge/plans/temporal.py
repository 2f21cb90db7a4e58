"""Queries that judge each row as of its own time, with their SQL."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import cohort, enrich, filters, intervals
from tidegauge.plans import adapters as a
from tidegauge.plans.oracles import GEO, HITS, LINES
from tidegauge.schemas import IDENTITY_FIELDS
from tidegauge.session import shared_dir
from tidegauge.sources import access_log
from tidegauge.streaming import jobs as stream_jobs
from tidegauge.streaming import sinks, stateful
from tidegauge.streaming.sources import table_stream

QUERIES = {}
ORACLES = {}


def _query(sql: str, *tables: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = "WITH " + ",".join((HITS, *tables)) + sql
        return f

    return register


MONTH = 1704067200

GENERATIONS = f"""
gens AS (
  SELECT *, {MONTH} + CAST(g AS BIGINT) * 8 * 86400 + custkey * 7919 % 86400 AS since,
    CASE WHEN custkey % 2 = 0
      THEN {MONTH} + (CAST(g AS BIGINT) * 8 + 7) * 86400 + custkey * 7919 % 86400 END AS until
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS g, CAST(custkey AS VARCHAR) AS c FROM users)
),
history AS (
  SELECT 'esn:' || left(md5(c), 26) AS session, * FROM gens WHERE balance >= 0
  UNION ALL SELECT 'api:' || md5(c) || left(md5(c), 8) AS session, * FROM gens WHERE segment <> 'BUILDING'
)"""

KNOWN_AT = """
keyed AS (
  SELECT *, site = 'openapi' AND NOT is_page AS open, variant NOT IN (1, 2) AND k % 9 <> 4 AS whole,
    CASE WHEN is_page OR site = 'openapi' THEN NULL
      WHEN site = 'esn' THEN CASE WHEN cookie LIKE 'PHPSESSID=%' THEN 'esn:' || sess END
      ELSE 'api:' || used_token END AS session
  FROM used
),
known_at AS (
  SELECT q.*, CASE WHEN h.until IS NULL OR h.until > q.created THEN h.custkey END AS owner, h.org AS owner_org,
    h.g AS g
  FROM keyed q ASOF LEFT JOIN history h ON q.session = h.session AND q.created >= h.since
)"""


@_query(
    """ SELECT event_id, n_fields, created,
      CASE WHEN open THEN CASE WHEN whole AND k % 9 <> 5 THEN CAST(custkey AS VARCHAR) END
        ELSE owner || '-' || g END AS member_id,
      CASE WHEN open THEN CASE WHEN whole THEN CAST(custkey % 20 AS VARCHAR) END
        ELSE CAST(owner % 20 AS VARCHAR) END AS qz_id,
      CASE WHEN NOT open THEN owner || '-' || g END AS user_id,
      CASE WHEN open THEN CASE WHEN whole THEN CAST(k AS VARCHAR) END
        WHEN owner IS NOT NULL THEN owner_org END AS instance_id
    FROM known_at""",
    LINES,
    GENERATIONS,
    KNOWN_AT,
)
def identity_as_of(spark, sf):
    """Who made each request: by the session that its token stood for at that time."""
    parsed = access_log.parse_lines(a.lines(spark, sf))
    history = a.session_history(a.users(spark, sf))
    known = enrich.with_identity_at(parsed, history)
    created = F.unix_seconds("ts").alias("created")
    return known.select(F.col("connection").alias("event_id"), "n_fields", created, *IDENTITY_FIELDS)


@_query(
    f""" SELECT event_id, h.ip, country, region, city || '-' || g AS city
    FROM (SELECT event_id, ip, epoch_us(ts) AS us FROM hits) h ASOF LEFT JOIN
      (SELECT *, ({MONTH} + CAST(g AS BIGINT) * 10 * 86400 + custkey * 7919 % 86400) * 1000000 AS since
       FROM (SELECT *, CAST(split_part(ip, '.', 2) AS BIGINT) * 256 + CAST(split_part(ip, '.', 3) AS BIGINT)
               AS custkey, unnest([0, 1, 2, 3]) AS g FROM geo)) p
      ON h.ip = p.ip AND h.us >= p.since
    WHERE country IS NULL OR country <> '局域网'""",
    GEO,
)
def geo_as_of(spark, sf):
    """Where each request came from: by the place that its address had at that time."""
    log = a.hits(spark, sf).select("event_id", "ip", "ts")
    places = a.geo_history(a.located_users(spark, sf))
    return enrich.with_geo_at(log, places, "ip").drop("ts")


TIMED_PAYMENTS = """
timed AS (
  SELECT instance_id, epoch_us(ts) AS start,
    CASE WHEN k % 20 <> 3 THEN epoch_us(ts) + ((k % 9 + 1) * 6 * 3600 + k) * CAST(1000000 AS BIGINT) END AS stop,
    CASE WHEN k % 5 = 0 THEN 0.0 ELSE value END AS total_fee
  FROM log WHERE event_type = 'signup' AND instance_id IS NOT NULL
)"""


def _org_events(spark, sf) -> DataFrame:
    log = a.with_org(a.hits(spark, sf), a.users(spark, sf))
    return log.where(F.col("instance_id").isNotNull()).select("event_id", "ts", "instance_id")


def _timed_payments(spark, sf) -> DataFrame:
    return a.timed_payments(a.hits(spark, sf), a.users(spark, sf))


@_query(
    """ SELECT event_id, instance_id FROM log WHERE EXISTS (
      SELECT 1 FROM timed p WHERE p.instance_id = log.instance_id AND total_fee > 0
        AND epoch_us(log.ts) BETWEEN start AND coalesce(stop, 9223372036854775807))""",
    TIMED_PAYMENTS,
)
def paid_at_instant(spark, sf):
    """Requests of enterprises that were paying at the request's own instant."""
    kept = cohort.keep_paid_at(_org_events(spark, sf), _timed_payments(spark, sf))
    return kept.select("event_id", "instance_id")


@_query(
    """ SELECT event_id, count(*) AS payments, max(total_fee) AS highest_fee FROM log JOIN timed p
      ON p.instance_id = log.instance_id
        AND epoch_us(log.ts) BETWEEN start AND coalesce(stop, 9223372036854775807)
      GROUP BY event_id""",
    TIMED_PAYMENTS,
)
def payments_at_instant(spark, sf):
    """How many payments run at each request's instant, and the highest of them."""
    met = intervals.covering(
        _org_events(spark, sf), _timed_payments(spark, sf), ["instance_id"], how="count", value="total_fee"
    )
    return met.groupBy("event_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("payments"), F.max("highest").alias("highest_fee")
    )


# --- streams in order of time ------------------------------------------------------------

FIRST, SLICES, SLICE_DAYS = datetime(2024, 1, 1, tzinfo=timezone.utc), 4, 8
#: Files of a slice come in any order, so a row may be later than others by a slice.
SLICE_DELAY = "9 days"
#: A time after all others, which lets every window and session end.
LAST = datetime(2030, 1, 1, tzinfo=timezone.utc)


def in_order(spark: SparkSession, rows: DataFrame, ts: str, last: DataFrame, purpose: str) -> DataFrame:
    """A table as a stream of a few slices of time, one after another, and then a last row."""
    path = shared_dir(spark, purpose)
    starts = [FIRST + timedelta(days=k * SLICE_DAYS) for k in range(SLICES + 1)]
    for k in range(SLICES):
        low = F.lit(True) if k == 0 else F.col(ts) >= F.lit(starts[k])
        high = F.lit(True) if k == SLICES - 1 else F.col(ts) < F.lit(starts[k + 1])
        rows.where(low & high).write.mode("append").parquet(path)
    last.select(*rows.columns).write.mode("append").parquet(path)
    return table_stream(spark, f"{path}/", max_files=64)


def _last_of(rows: DataFrame, **values) -> DataFrame:
    """One row of the same columns: the given values, and NULL."""
    given = {c: F.lit(values[c]) if c in values else F.lit(None) for c in rows.columns}
    kinds = dict(rows.dtypes)
    return rows.sparkSession.range(1).select(*(v.cast(kinds[c]).alias(c) for c, v in given.items()))


STREAM_HISTORY = f"""
gens AS (
  SELECT *, {MONTH} + CAST(g AS BIGINT) * 8 * 86400 + custkey * 7919 % 86400 AS since,
    CASE WHEN custkey % 2 = 0 THEN 7 ELSE 8 END * 86400 AS life
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS g FROM users WHERE segment <> 'BUILDING')
)"""


@_query(
    """ SELECT event_id, g.custkey || '-' || g AS member_id, CAST(g.custkey % 20 AS VARCHAR) AS qz_id,
      g.custkey || '-' || g AS user_id, g.org AS instance_id
    FROM hits h LEFT JOIN gens g ON g.custkey = h.custkey AND h.k % 10 <> 0
      AND epoch_us(h.ts) >= since * 1000000 AND epoch_us(h.ts) < (since + life) * 1000000""",
    STREAM_HISTORY,
)
def stream_identity(spark, sf):
    """Requests as a stream, with identity from a stream of sessions; both in slices of time."""
    digest = F.md5(F.col("custkey").cast("string"))
    token = F.concat(F.lit("api:"), digest, F.substring(digest, 1, 8))
    hits = a.hits(spark, sf).select("event_id", "ts", F.when(F.col("k") % 10 != 0, token).alias("session"))
    history = a.session_history(a.users(spark, sf)).where(F.col("kind") == "api")
    sessions = history.select(
        F.concat_ws(":", "kind", "token").alias("session"), "since", "until", *IDENTITY_FIELDS
    )
    log = in_order(spark, hits, "ts", _last_of(hits, event_id=-1, ts=LAST, session="end"), "hits")
    held = in_order(spark, sessions, "since", _last_of(sessions, session="end", since=LAST), "sessions")
    known = stateful.with_session_stream(log, held, SLICE_DELAY, "8 days")
    out = shared_dir(spark, "identity")
    stream_jobs.run(known, sinks.append_batch(f"{out}/data"), f"{out}/checkpoint")
    stored = spark.read.parquet(f"{out}/data").where("event_id >= 0")
    return stored.select("event_id", *IDENTITY_FIELDS)


@_query(
    """ SELECT hour AS created, count(DISTINCT member_id) AS num FROM hits
    WHERE site <> 'openapi' AND member_id IS NOT NULL GROUP BY hour"""
)
def stream_uv_chained(spark, sf):
    """Hourly UV from one query: keys pass once through the state store, then are counted there."""
    hits = a.hits(spark, sf).where(filters.not_openapi()).select("ts", "member_id")
    log = in_order(spark, hits, "ts", _last_of(hits, ts=LAST, member_id="end"), "visits")
    counted = stateful.running_visitors(log, SLICE_DELAY, splits=4)
    out = shared_dir(spark, "uv-chained")
    stream_jobs.run(counted, sinks.append_batch(f"{out}/data", "dt"), f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data").select("created", "num")
