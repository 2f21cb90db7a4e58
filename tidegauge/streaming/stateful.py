"""Streams whose answer lives in the state store: identity from a second stream, and running visitors.

State is bounded by event time. A row later than the watermark is dropped, which the additive counters of
``streaming.jobs`` never do; choose the delay accordingly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timebuckets import DAY, HOUR, day_of
from tidegauge.schemas import IDENTITY_FIELDS

LENGTHS = {"hour": HOUR, "day": DAY}


def with_session_stream(
    log: DataFrame,
    sessions: DataFrame,
    delay: str,
    life: str,
    values: Sequence[str] = IDENTITY_FIELDS,
    at: str = "ts",
) -> DataFrame:
    """Rows of a stream with the values of the session that holds under their key at their own time.

    Both are streams: ``log`` has ``session`` and a time, ``sessions`` has ``session, since, until`` and the
    values. A session holds from ``since`` to before ``until``, and no longer than ``life``, which bounds the
    state; those of one key must not overlap. A row may come before its session or after it, by up
    to ``delay``. A row without one comes out, with NULLs, once the delay has passed.
    """
    lifetime = F.expr(f"INTERVAL {life}")
    # Rows without a key find nothing; a hash spreads them over the tasks.
    nobody = F.concat(F.lit("\u0000"), F.xxhash64(*log.columns).cast("string"))
    left = log.withColumn("_key", F.coalesce("session", nobody)).withWatermark(at, delay)
    right = sessions.select(
        F.col("session").alias("_session"),
        F.col("since").alias("_since"),
        F.col("until").alias("_until"),
        *(F.col(v).alias(f"_{v}") for v in values),
    ).withWatermark("_since", delay)
    holds = (
        (F.col("_key") == F.col("_session"))
        & (F.col(at) >= F.col("_since"))
        & (F.col(at) < F.col("_since") + lifetime)
        & F.coalesce(F.col(at) < F.col("_until"), F.lit(True))
    )
    met = left.join(right, holds, "leftOuter")
    return met.select(*log.columns, *(F.col(f"_{v}").alias(v) for v in values))


def running_visitors(
    log: DataFrame,
    delay: str,
    value: str = "member_id",
    unit: str = "hour",
    ts: str = "ts",
    splits: int = 1,
) -> DataFrame:
    """``(dt, created, num)``: distinct values per hour or day, each final once the delay has passed.

    One query of chained stateful operators: keys pass once within the watermark, then are counted
    per window. ``delay`` must be at least as long as the unit, or a key's state could end before its
    window. With ``splits``, a key's rows are first told apart within so many shares, so that the
    task of a hot key gets at most that many rows of it; its state then has up to as many rows more.
    Windows are those of UTC.
    """
    length = f"{LENGTHS[unit]} seconds"
    seen = log.where(F.col(value).isNotNull()).select(
        F.col(ts).alias("_ts"), F.col(value).alias("_value"), F.floor(F.unix_seconds(ts) / LENGTHS[unit]).alias("_unit")
    )
    seen = seen.withColumn("_share", F.pmod(F.xxhash64("_ts", "_value"), F.lit(splits)))
    seen = seen.withWatermark("_ts", delay)
    if splits > 1:
        seen = seen.dropDuplicatesWithinWatermark(["_unit", "_value", "_share"])
    once = seen.dropDuplicatesWithinWatermark(["_unit", "_value"])
    counted = once.groupBy(F.window("_ts", length)).agg(F.count(F.lit(1)).alias("num"))
    begun = F.col("window.start")
    return counted.select(day_of(begun).alias("dt"), F.unix_seconds(begun).alias("created"), "num")
