"""Access-log lines: parsing raw and enriched text into typed columns, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import blank_to_null, field_count
from tidegauge.functions.timebuckets import log_time
from tidegauge.schemas import ACCESS_FIELDS, GEO_FIELDS, IDENTITY_FIELDS

# Fixed value: text that stands for a missing value in enriched lines.
MISSING = "empty"


def _typed(part: Column, kind: str) -> Column:
    return part if kind == "string" else part.try_cast(kind)


def parse_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """One typed column per field, ``ts`` for the time, ``n_fields`` for the field count.

    Bad numbers and times become NULL and short lines get NULL fields; no row is
    dropped here. ``line`` itself is kept because the request filter looks at all of it.
    """
    fields = [
        _typed(F.get("_parts", F.lit(i)), kind).alias(name)
        for i, (name, kind) in enumerate(ACCESS_FIELDS)
    ]
    # Split once per line: as a generated row, the split is not copied into every later filter.
    split = df.select("*", F.explode(F.array(F.split(F.col(line), "\t"))).alias("_parts"))
    parsed = split.select(*df.columns, field_count(line).alias("n_fields"), *fields)
    return parsed.withColumn("ts", log_time("time_local"))


def _labelled(part: Column, name: str) -> Column:
    """Value of a ``name:value`` field; NULL for a missing one."""
    value = F.regexp_extract(part, f"^{name}:([^:]+)$", 1)
    return F.nullif(blank_to_null(value), F.lit(MISSING))


def parse_enriched_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """``parse_lines`` plus the geography and identity fields 20-26."""
    parts = F.split(F.col(line), "\t")
    first = len(ACCESS_FIELDS)
    labelled = [
        _labelled(F.get(parts, F.lit(first + i)), name).alias(name)
        for i, name in enumerate(GEO_FIELDS + IDENTITY_FIELDS)
    ]
    return parse_lines(df, line).select("*", *labelled)


def render_line(fields: dict[str, Column]) -> Column:
    """A raw line from one text column per field."""
    return F.concat_ws("\t", *[fields[name].cast("string") for name, _ in ACCESS_FIELDS])


def render_enriched_line(line: Column) -> Column:
    """A raw line followed by its geography and identity columns as ``name:value``."""
    labelled = [
        F.concat(F.lit(f"{name}:"), F.coalesce(F.col(name), F.lit(MISSING)))
        for name in GEO_FIELDS + IDENTITY_FIELDS
    ]
    return F.concat_ws("\t", line, *labelled)
