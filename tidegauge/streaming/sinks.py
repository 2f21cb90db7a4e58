"""Batch sinks that give the same table when a batch is written twice.

Each micro-batch writes its own ``batch`` partition, by overwriting it. A batch
that is replayed after a failure replaces what it wrote before, so additive
counters do not count twice. Reading a table sums its batches, or takes the latest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sources.archive import overwrite_partitions, read_if_stored, replace_partition

Sink = Callable[[DataFrame, int], None]


def append_batch(path: str, *partitions: str, balanced: bool = True) -> Sink:
    """Stores the rows of each batch under ``partitions`` and ``batch``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id))
        overwrite_partitions(rows, path, *partitions, "batch", balanced=balanced)

    return write


def aggregated(aggregate: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    """Aggregates within the batch, on the map side first, before storing it."""
    return lambda batch, batch_id: sink(aggregate(batch), batch_id)


def both(*sinks: Sink) -> Sink:
    """Several outputs of one batch, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def read_sums(
    spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str] = ("num",)
) -> DataFrame:
    """Counters added up over all batches."""
    sums = [F.sum(v).alias(v) for v in values]
    return spark.read.parquet(path).groupBy(*keys).agg(*sums)


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str] = ("num",)
) -> DataFrame:
    """Values of the last batch that wrote each key."""
    last = [F.max_by(v, "batch").alias(v) for v in values]
    return spark.read.parquet(path).groupBy(*keys).agg(*last)


def settle(spark: SparkSession, path: str, partition: str, value) -> None:
    """Puts the rows of a closed partition's batches into few files of a table beside it.

    Run once a day for the day before. The batches stay until :func:`read_settled` no longer
    reads them; a second run gives the same files.
    """
    closed = spark.read.parquet(path).where(F.col(partition) == F.lit(value)).drop("batch")
    replace_partition(closed, f"{path}-settled", **{partition: value})


def read_settled(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Rows of settled partitions, and of the batches of all others."""
    batches = spark.read.parquet(path).drop("batch")
    settled = read_if_stored(spark, f"{path}-settled")
    if settled is None:
        return batches
    # As literals, so that the scan prunes the folders; there is one for each day.
    days = [row[0] for row in settled.select(partition).distinct().collect()]
    return batches.where(~F.col(partition).isin(days)).unionByName(settled)


def settle_sums(
    spark: SparkSession, path: str, out: str, partition: str, value, keys: Sequence[str]
) -> None:
    """Adds up the batches of one closed partition into a report table.

    Run once a day for the day before; its many small batch files need not be read again.
    """
    closed = spark.read.parquet(path).where(F.col(partition) == F.lit(value))
    summed = closed.groupBy(partition, *keys).agg(F.sum("num").alias("num"))
    overwrite_partitions(summed, out, partition)
