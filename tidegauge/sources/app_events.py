"""App and behaviour events: JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegauge.functions.text import blank_to_null
from tidegauge.functions.timebuckets import instant_of_millis
from tidegauge.schemas import EVENT_FIELDS, EVENT_SCHEMA


def parse_events(df: DataFrame, line: str = "value") -> DataFrame:
    """One column per event key plus ``ts``; lines without a usable ``mtime`` are dropped."""
    # As a generated row, the text is parsed once and not again inside the filters.
    event = F.explode(F.array(F.from_json(F.col(line), EVENT_SCHEMA))).alias("event")
    millis = F.col("mtime").try_cast("bigint")
    return (
        df.where(F.col(line).contains("mtime"))
        .select(event)
        .select("event.*")
        .withColumn("ts", instant_of_millis(millis))
        .where(F.col("ts").isNotNull())
    )


def parse_behaviour(df: DataFrame, line: str = "value") -> DataFrame:
    """``(mtime, payload)`` of any JSON object that carries a usable ``mtime``."""
    mtime = blank_to_null(F.get_json_object(F.col(line), "$.mtime")).try_cast("bigint")
    return df.select(mtime.alias("mtime"), F.col(line).alias("payload")).where(
        instant_of_millis("mtime").isNotNull()
    )


def count_rejects(df: DataFrame, line: str = "value") -> DataFrame:
    """How many lines the parsers above drop, by reason."""
    raw = F.get_json_object(F.col(line), "$.mtime")
    reason = (
        F.when(raw.isNull(), "no mtime")
        .when(raw.try_cast("bigint").isNull(), "mtime is no whole number")
        .when(instant_of_millis(raw.try_cast("bigint")).isNull(), "mtime is out of range")
    )
    bad = df.select(reason.alias("reason")).where(F.col("reason").isNotNull())
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("num"))


#: Why a line is dropped, by the name of its counter.
REASONS = {
    "no_mtime": "no mtime",
    "no_number": "mtime is no whole number",
    "out_of_range": "mtime is out of range",
}


def parse_events_observed(df: DataFrame, observation: Observation | str, line: str = "value") -> DataFrame:
    """:func:`parse_events`, with counts of all lines and of those dropped, by reason, as observed metrics.

    The counts come with whatever action runs on the result, in the same pass: ``lines``, ``kept`` and the
    names of ``REASONS``.
    """
    event = F.explode(F.array(F.from_json(F.col(line), EVENT_SCHEMA))).alias("event")
    millis = F.col("mtime").try_cast("bigint")
    timed = df.select(event).select("event.*").withColumn("ts", instant_of_millis(millis))
    bad = {
        "no_mtime": F.col("mtime").isNull(),
        "no_number": F.col("mtime").isNotNull() & millis.isNull(),
        "out_of_range": millis.isNotNull() & F.col("ts").isNull(),
    }
    counts = [F.count_if(condition).alias(name) for name, condition in bad.items()]
    kept = F.count_if(F.col("ts").isNotNull()).alias("kept")
    watched = timed.observe(observation, F.count(F.lit(1)).alias("lines"), kept, *counts)
    return watched.where(F.col("ts").isNotNull())


def parse_behaviour_variant(df: DataFrame, line: str = "value") -> DataFrame:
    """``(mtime, payload)`` like :func:`parse_behaviour`, with the payload parsed once, as VARIANT.

    Lines that are no JSON, or repeat a key in an object, are dropped. Fields are read by
    ``try_variant_get`` without parsing the text again.
    """
    # A generated row, so that the text is parsed once and not again in the filter.
    parsed = df.select(F.explode(F.array(F.try_parse_json(F.col(line)))).alias("payload"))
    mtime = blank_to_null(F.try_variant_get("payload", "$.mtime", "string")).try_cast("bigint")
    timed = parsed.select(mtime.alias("mtime"), "payload")
    return timed.where(instant_of_millis("mtime").isNotNull())


def render_event(fields: dict[str, Column]) -> Column:
    """JSON text of an event; keys follow the event schema, NULL keys are left out."""
    present = [fields[name].cast("string").alias(name) for name in EVENT_FIELDS if name in fields]
    return F.to_json(F.struct(*present))
