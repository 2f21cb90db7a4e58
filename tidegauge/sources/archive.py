"""Time-partitioned Parquet archives.

Partition columns take the place of time-ordered row keys: ``dt`` (DATE) and,
for hourly jobs, ``hr`` (INT). Every reader filters on them, so a scan lists and
opens only the days it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.asof import last_hour, month_start, week_start, yesterday
from tidegauge.functions.timebuckets import day_of, hour_of, wall_clock


def with_partitions(df: DataFrame, ts: str = "ts", tz: str = "UTC") -> DataFrame:
    return df.withColumn("dt", day_of(ts, tz)).withColumn("hr", hour_of(ts, tz))


def _balanced(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Groups rows by partition for few files, splitting a partition that is too big.

    A plain ``repartition("dt")`` would send a whole busy day to one task; a
    rebalance lets AQE cut it into target-sized pieces.
    """
    return df.hint("rebalance", *cols)


def append_partitioned(df: DataFrame, path: str, *cols: str) -> None:
    _balanced(df, cols).write.mode("append").partitionBy(*cols).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *cols: str, balanced: bool = True) -> None:
    """Replaces just the partitions present in ``df``, so a re-run does not duplicate.

    Unbalanced, tasks write what they have, without a shuffle, and into more files.
    """
    (
        (_balanced(df, cols) if balanced else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, **values: object) -> None:
    """Puts the rows in place of the named partition, also when there are none.

    The folder keeps a file with the schema, so a table whose days are all empty can be read.
    """
    folder = "/".join(f"{column}={value}" for column, value in values.items())
    df.drop(*values).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{folder}")


def write_text(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Dumps rows as text, one file per task."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *cols).alias("value")).write.mode("overwrite").text(path)


def read_days(
    spark: SparkSession, path: str, start: date, end: date, partition: str = "dt"
) -> DataFrame:
    """Archive rows of the days ``start`` to ``end``, both included."""
    return spark.read.parquet(path).where(F.col(partition).between(F.lit(start), F.lit(end)))


def read_if_stored(
    spark: SparkSession, path: str, partition: str | None = None, values: Sequence = ()
) -> DataFrame | None:
    """The table at ``path``, or None before its first write.

    With a partition column, only the folders of ``values`` are listed, however
    many others the table has; None if there are none of them yet.
    """
    reader = spark.read.option("basePath", path)
    if partition is not None:
        names = ",".join(str(v) for v in values)
        path = f"{path}/{partition}={{{names}}}"
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_yesterday(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    day = yesterday(as_of)
    return read_days(spark, path, day, day)


def read_last_hour(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    hour = last_hour(as_of)
    rows = read_days(spark, path, hour.date(), hour.date())
    return rows.where(F.col("hr") == F.lit(hour.hour))


def read_periods(
    spark: SparkSession, path: str, unit: str, start: date, end: date
) -> DataFrame:
    """Key-set rows of the weeks or months that ``start`` to ``end`` touch."""
    floor = {"week": week_start, "month": month_start}[unit]
    wanted = F.col("period_start").between(F.lit(floor(start)), F.lit(floor(end)))
    return spark.read.parquet(path).where(wanted)


def _between(ts: Column | str, low: datetime, high: datetime) -> Column:
    """Range predicate on a bare zone-less time column; the Parquet scan can use it."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (ts >= wall_clock(low)) & (ts < wall_clock(high))


def between_days(ts: Column | str, start: date, end: date) -> Column:
    """Times of the days ``start`` to ``end``, both included."""
    midnight = datetime.min.time()
    after = datetime.combine(end + timedelta(days=1), midnight)
    return _between(ts, datetime.combine(start, midnight), after)


def in_hour(ts: Column | str, hour: datetime) -> Column:
    return _between(ts, hour, hour + timedelta(hours=1))
