"""Stream sources: a Kafka topic in production, folders of files in tests."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Trigger intervals of the four streams.
TRIGGERS = {
    "access": "10 seconds",
    "promo": "30 seconds",
    "app_events": "5 seconds",
    "behaviour": "5 seconds",
}


def starting_offsets(
    topic: str, latest: Mapping[int, int], committed: Mapping[int, int], replay: int = 0
) -> str:
    """Where a first run starts: committed offsets before latest ones, ``replay`` messages back.

    Later runs ignore this and resume from their checkpoint.
    """
    merged = {**latest, **committed}
    start = {str(p): max(offset - replay, 0) for p, offset in sorted(merged.items())}
    return json.dumps({topic: start})


def kafka_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_lines(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Message texts as ``value``; needs Spark's Kafka package on the class path."""
    options = kafka_options(servers, topic, **kwargs)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.selectExpr("CAST(value AS STRING) AS value")


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream, with the schema it has now."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A glob, because a stream source takes folders and patterns only.
    return reader.parquet(f"{path}*")
