"""Lookup replies (JSON) as dimension rows.

Identity, geography and app lookups are joined as tables. These parsers load
such a table from stored replies; a reply whose ``ecode`` is not "0" gives NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.schemas import APP_REPLY, GEO_REPLY, IDENTITY_REPLY

OK = "0"


def _with_result(df: DataFrame, reply: str, schema: str) -> DataFrame:
    """Adds ``_found``, the payload of a good reply; the text is parsed in a step of its own."""
    parsed = df.withColumn("_reply", F.from_json(F.col(reply), schema))
    return parsed.withColumn("_found", F.when(F.col("_reply.ecode") == OK, F.col("_reply.result")))


def parse_identity_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds member_id, qz_id, user_id and instance_id."""
    found = _with_result(df, reply, IDENTITY_REPLY)
    names = ("member_id", "qz_id", "user_id", "instance_id")
    return found.select(*df.columns, *[F.col(f"_found.{n}").alias(n) for n in names])


def parse_geo_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds geo_ip, country, region and city; the result is keyed by the address."""
    found = _with_result(df, reply, GEO_REPLY)
    entry = F.get(F.map_entries("_found"), F.lit(0))
    return found.withColumn("_entry", entry).select(
        *df.columns,
        F.col("_entry.key").alias("geo_ip"),
        *[F.col(f"_entry.value.{n}").alias(n) for n in ("country", "region", "city")],
    )


def parse_app_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds open_appid and name."""
    found = _with_result(df, reply, APP_REPLY)
    return found.select(
        *df.columns, *[F.col(f"_found.{n}").alias(n) for n in ("open_appid", "name")]
    )
