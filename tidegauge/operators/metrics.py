"""Period metrics: counts, sums and exact distinct counts per time bucket and keys.

Every metric first folds its rows on the map side into one row per bucket, keys
and distinct values, then counts. A key that holds a large share of the rows is
thus a few rows by the time anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.labels import ELSEWHERE, REGION_CODES
from tidegauge.functions.timebuckets import bucket, coarser
from tidegauge.schemas import ALL_CLIENTS, PERIOD_TYPE

HITS = "hits"


def fold(
    df: DataFrame,
    unit: str,
    *dims: str,
    sums: Sequence[str] = (),
    ts: str = "ts",
    tz: str = "UTC",
) -> DataFrame:
    """Rows folded to one per bucket and ``dims``, with ``hits`` and the sums.

    Use before a join, so that the join sees folded rows instead of raw ones.
    """
    totals = [F.count(F.lit(1)).alias(HITS), *[F.sum(c).alias(c) for c in sums]]
    return df.groupBy(bucket(ts, unit, tz).alias("created"), *dims).agg(*totals)


def period_metrics(
    folded: DataFrame,
    keys: Sequence[str] = (),
    distinct: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Metrics per ``created`` and ``keys`` of folded rows, all in one pass.

    ``distinct`` and ``sums`` map a result name to the column it counts or adds
    up; ``{"pv": "hits"}`` is the request count. NULLs are not counted.
    """
    distinct, sums = dict(distinct or {}), dict(sums or {})
    aggs = [F.countDistinct(col).alias(name) for name, col in distinct.items()]
    aggs += [F.sum(col).alias(name) for name, col in sums.items()]
    return folded.groupBy("created", *keys).agg(*aggs)


def labelled(df: DataFrame, unit: str, clients: bool = False) -> DataFrame:
    """Adds the report's ``type`` and, where it has one, ``client_type``."""
    typed = df.withColumn("type", F.lit(PERIOD_TYPE[unit]))
    return typed.withColumn("client_type", F.lit(ALL_CLIENTS)) if clients else typed


def distinct_per_period(
    df: DataFrame, unit: str, value: str, ts: str = "ts", tz: str = "UTC"
) -> DataFrame:
    """``(created, num)``: distinct values of one column per bucket."""
    created = bucket(ts, unit, tz).alias("created")
    return df.groupBy(created).agg(F.countDistinct(value).alias("num"))


def distinct_day_and_hour(
    df: DataFrame, value: str, ts: str = "ts", tz: str = "UTC"
) -> DataFrame:
    """``(type, created, num)`` for days and hours together.

    The raw rows are folded once to distinct (hour, value); both levels count that.
    """
    seen = (
        df.where(F.col(value).isNotNull())
        .select(bucket(ts, "hour", tz).alias("hour"), F.col(value).alias("value"))
        .distinct()
        .withColumn("day", coarser("hour", "day", tz))
    )
    sets = seen.groupingSets([("day",), ("hour",)], "day", "hour").agg(
        F.countDistinct("value").alias("num")
    )
    by_day = F.col("hour").isNull()
    return sets.select(
        F.when(by_day, PERIOD_TYPE["day"]).otherwise(PERIOD_TYPE["hour"]).alias("type"),
        F.coalesce("hour", "day").alias("created"),
        "num",
    )


def page_views(folded: DataFrame, region: str = "region_code") -> DataFrame:
    """``(created, region, num)``: requests per bucket and region code."""
    return folded.groupBy("created", F.col(region).alias("region")).agg(F.sum(HITS).alias("num"))


def page_views_wide(
    long: DataFrame, codes: Sequence[str] = (ELSEWHERE, *REGION_CODES.values())
) -> DataFrame:
    """One row per bucket with a counter per region code, 0 where there was no request."""
    wide = long.groupBy("created").pivot("region", list(codes)).agg(F.sum("num"))
    counters = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(c) for c in codes]
    return wide.select(F.lit(ALL_CLIENTS).alias("client_type"), "created", *counters)


def count_by(df: DataFrame, *keys: str | Column, name: str = "num") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_keys(counts: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` largest counts; equal counts in key order, so the result is stable."""
    return counts.orderBy(F.desc("num"), *keys).limit(n)


def repeated_keys(counts: DataFrame) -> DataFrame:
    """Keys seen more than once."""
    return counts.where(F.col("num") > 1)
