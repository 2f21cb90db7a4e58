"""Queries through stored tables: bucketed key sets, bitmaps, sketches, searches; with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidegauge.functions.asof import month_start
from tidegauge.functions.timebuckets import bucket_of_millis, day_epoch, day_of, period_start
from tidegauge.operators import bitmaps, heavy_hitters, key_sets
from tidegauge.plans import adapters as a
from tidegauge.plans import queries as q
from tidegauge.plans.oracles import HITS
from tidegauge.plans.oracles import ORACLES as BASE
from tidegauge.schemas import ALL_CLIENTS, PERIOD_TYPE
from tidegauge.session import shared_dir
from tidegauge.sources import app_events, searchable
from tidegauge.sources.archive import overwrite_partitions
from tidegauge.sources.bucketed import BucketedSet
from tidegauge.streaming import jobs as stream_jobs

QUERIES = {}
ORACLES = {}


def _query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


@_query(BASE["incremental_distinct"])
def incremental_bucketed(spark, sf):
    """Month keys of the first half of the data, stored in buckets, and the second half's appended to them."""
    ids, path = key_sets.KEY_SETS["eu"], shared_dir(spark, "month_eu")
    month = month_start(q.AS_OF)
    keys = BucketedSet.of(spark, path, "period_start", month, ids)
    for half in q._halves():
        found = key_sets.first_days(q._facts(spark, sf, half), "month", ids)
        keys.append(found.where(F.col("period_start") == F.lit(month)))
    stored = spark.read.parquet(path)
    return stored.select(q._day_text("period_start"), *ids)


def _register_bitmaps() -> None:
    for unit in ("week", "month"):
        for metric, value in (("uv", "member_id"), ("ev", "instance_id")):

            def count(spark, sf, unit=unit, metric=metric, value=value):
                """Days stored as bitmaps over a stored dictionary, and the period as their OR."""
                root = shared_dir(spark, f"bitmaps-{metric}")
                facts = q._facts(spark, sf).where(F.col("day") <= F.lit(q.AS_OF))
                dictionary = bitmaps.grown_dictionary(spark, f"{root}/ids", facts.select(value))
                overwrite_partitions(bitmaps.bitmaps_of(facts, dictionary, value, "day"), f"{root}/days", "day")
                days = spark.read.parquet(f"{root}/days")
                periods = bitmaps.merged_bitmaps(days, period_start("day", unit).alias("period_start"))
                counted = bitmaps.count_bits(periods, "period_start")
                labels = [F.lit(PERIOD_TYPE[unit]).alias("type")]
                if metric == "uv":
                    labels.append(F.lit(ALL_CLIENTS).alias("client_type"))
                created = day_epoch(F.lit(q.AS_OF)).alias("created")
                return counted.select(*labels, q._day_text("period_start"), created, "num")

            QUERIES[f"{metric}_{unit}_bitmap"] = count
            ORACLES[f"{metric}_{unit}_bitmap"] = BASE[f"{metric}_{unit}"]


_register_bitmaps()


@_query(BASE["top_keys"])
def top_keys_sketched(spark, sf):
    """The top keys from daily sketches, stored, combined and counted exactly."""
    events = q._app_events(spark, sf)
    keys = ("object_id", "user_id", "action")
    path = shared_dir(spark, "sketches")
    day = day_of("ts").alias("day")
    overwrite_partitions(heavy_hitters.sketches(events, keys, day), path, "day")
    return heavy_hitters.top_keys_bounded(events, 50, *keys, parts=spark.read.parquet(path))


@_query(BASE["behaviour_events"])
def behaviour_variant(spark, sf):
    """Behaviour rows archived as VARIANT by a stream and read back."""
    events = a.as_app_events(a.as_hits(q._stream(spark, sf, "events")))
    path = q._run(spark, events, "behaviour-variant", stream_jobs.behaviour_variant_sink)
    return spark.read.parquet(path).select(
        "mtime",
        bucket_of_millis("mtime", "day").alias("created"),
        F.try_variant_get("payload", "$.action", "string").alias("action"),
    )


@_query(
    "WITH " + HITS + """ SELECT event_id, event_type AS action, member_id, ms AS mtime FROM hits
    WHERE member_id IN ('7', '70', '133') AND event_type IN ('purchase', 'click')
      AND CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'"""
)
def row_grep(spark, sf):
    """Single members' purchases and clicks, from an archive that is sorted by member."""
    events = q._app_events(spark, sf).withColumn("dt", day_of("ts"))
    path = shared_dir(spark, "searchable")
    searchable.write_searchable(events, path, "dt")
    found = searchable.grep(
        spark, path, ["7", "70", "133"], ["purchase", "click"], date(2024, 1, 3), date(2024, 1, 20)
    )
    number = F.col("ver_code").cast("bigint").alias("event_id")
    return found.select(number, "action", "member_id", F.col("mtime").cast("bigint").alias("mtime"))


@_query(
    "WITH " + HITS + """, texts AS (
      SELECT CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN 'soon' WHEN 2 THEN '99999999999999999'
        ELSE CAST(ms AS VARCHAR) END AS mtime FROM hits)
    SELECT 'lines' AS reason, count(*) AS num FROM texts
    UNION ALL SELECT 'kept', count(*) FROM texts WHERE length(mtime) BETWEEN 5 AND 15
    UNION ALL SELECT 'no mtime', count(*) FROM texts WHERE mtime IS NULL
    UNION ALL SELECT 'mtime is no whole number', count(*) FROM texts WHERE mtime = 'soon'
    UNION ALL SELECT 'mtime is out of range', count(*) FROM texts WHERE length(mtime) = 17"""
)
def event_rejects(spark, sf):
    """Events archived by a stream, with the reasons of dropped ones counted while they are written."""
    log = a.as_hits(q._stream(spark, sf, "events"))
    k = F.col("k") % 10
    good = F.unix_millis("ts").cast("string")
    mtime = F.when(k == 1, "soon").when(k == 2, "99999999999999999").when(k != 0, good)
    fields = {"action": F.col("event_type"), "mtime": mtime}
    lines = log.select(app_events.render_event(fields).alias("value"))
    path = q._run(
        spark, lines, "rejects", lambda p: stream_jobs.counted_event_sink(f"{p}/events", f"{p}/rejects")
    )
    counted = spark.read.parquet(f"{path}/rejects")
    return counted.groupBy("reason").agg(F.sum("num").alias("num"))
