"""App events: normalised app ids and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.operators.joins import lookup

# An app known only by its open id has no name and app id 0.
NO_NAME = "empty"
NO_APP = "0"
# Fixed number of numbering groups, whatever the number of apps.
BUCKET_DIGITS = 3


def normalize_apps(events: DataFrame, apps: DataFrame) -> DataFrame:
    """Adds ``open_appid`` and ``name`` and settles ``app_id``.

    An app id with a sign is an open id itself. Any other is looked up in
    ``apps`` (one row per app_id); rows found without open id or name are
    dropped. An app with an open id is known by that alone: its app_id is 0.
    """
    named = events.where(F.col("app_id").isNotNull() & (F.col("app_id") != ""))
    signed = F.col("app_id").rlike("[-+]")
    keyed = named.withColumn("_app", F.when(~signed, F.col("app_id")))
    dim = apps.select(
        F.col("app_id").alias("_app"),
        F.col("open_appid").alias("_open"),
        F.col("name").alias("_name"),
    )
    found = lookup(keyed, dim, "_app", "_open", "_name")
    open_appid = F.when(signed, F.col("app_id")).otherwise(F.col("_open"))
    name = F.when(signed, F.lit(NO_NAME)).otherwise(F.col("_name"))
    settled = found.withColumns({"open_appid": open_appid, "name": name}).where(
        (F.col("open_appid") != "") & (F.col("name") != "")
    )
    app_id = F.when(F.col("open_appid") == NO_APP, F.col("app_id")).otherwise(NO_APP)
    return settled.withColumn("app_id", app_id).drop("_app", "_open", "_name")


def _numbered(pairs: DataFrame) -> DataFrame:
    """Adds ``n`` = 1, 2, ... without bringing the rows together in one task.

    Rows are numbered inside groups named by the first digits of a hash, and each
    group starts after the rows of the groups before it. There are 4096 groups
    however many rows there are, so the running total over groups stays that small.
    """
    digest = F.md5(F.concat_ws("|", "app_id", "open_appid"))
    grouped = pairs.withColumn("_group", F.substring(digest, 1, BUCKET_DIGITS))
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_group")) - F.col("_size")
    starts = sizes.select("_group", before.alias("_before"))
    inside = F.row_number().over(W.partitionBy("_group").orderBy("app_id", "open_appid"))
    return (
        grouped.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_group")
        .withColumn("n", F.col("_before") + F.col("_inside"))
        .drop("_group", "_before", "_inside")
    )


def assign_app_ids(events: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry ``(rpid, app_id, open_appid, name)`` with new apps appended.

    New ids follow the largest one there is, in an order that depends on the
    apps alone, so a repeated run gives the same ids.
    """
    pairs = events.groupBy("app_id", "open_appid").agg(F.min("name").alias("name"))
    new = pairs.join(registry, ["app_id", "open_appid"], "left_anti")
    top = registry.agg(F.coalesce(F.max("rpid"), F.lit(0)).alias("top")).scalar()
    ids = _numbered(new).select(
        (top + F.col("n")).cast("bigint").alias("rpid"), "app_id", "open_appid", "name"
    )
    return registry.select("rpid", "app_id", "open_appid", "name").unionByName(ids)


def with_rpid(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds the surrogate key of (app_id, open_appid)."""
    dim = registry.select("rpid", "app_id", "open_appid")
    return events.join(dim, ["app_id", "open_appid"], "inner")
