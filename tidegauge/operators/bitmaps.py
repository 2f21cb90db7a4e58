"""Exact distinct counts that merge: one bitmap per day over dense ids, and weeks and months as ORs of days.

A stored dictionary gives every key a number, dense from 1 and never changed, so a day's distinct
keys are the set bits of a few bitmaps: number n is bit ``bitmap_bit_position(n)`` of bitmap
``bitmap_bucket_number(n)``, 32,768 numbers to a bitmap. Days never read each other; a period of any
kind is an OR over the days' bitmaps, and its count the number of bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.sources.archive import read_if_stored

#: Groups that new keys are numbered in; their sizes alone are totalled in one place.
GROUPS = 4096
DICTIONARY = "id bigint, key string"


def numbered(keys: DataFrame, after: int = 0) -> DataFrame:
    """``(id, key)``: distinct keys numbered from ``after`` + 1 on without gaps, by their hash and value."""
    grouped = keys.where(F.col("key").isNotNull()).select("key").distinct()
    grouped = grouped.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(GROUPS)))
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy("key"))
    ids = (F.lit(after) + F.col("_before") + F.col("_inside")).cast("bigint").alias("id")
    # At most GROUPS rows.
    return grouped.withColumn("_inside", inside).join(F.broadcast(starts), "_group").select(ids, "key")


def grown_dictionary(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Appends the keys that the dictionary at ``path`` lacks, and returns it whole.

    A run again finds its keys there and adds nothing; there must be one writer at a time.
    """
    known = read_if_stored(spark, path)
    new = keys.select(F.col(keys.columns[0]).cast("string").alias("key")).where("key is not null").distinct()
    top = 0
    if known is not None:
        new = new.join(known.select("key"), "key", "left_anti")
        top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered(new, top).write.mode("append").parquet(path)
    return spark.read.schema(DICTIONARY).parquet(path)


def bitmaps_of(facts: DataFrame, dictionary: DataFrame, value: str, *by: str) -> DataFrame:
    """``(by, bucket, bits)``: the distinct values of each group as bitmaps; values not in the dictionary
    and NULLs are left out."""
    ids = dictionary.select(F.col("key").alias("_key"), F.col("id").alias("_id"))
    folded = facts.select(*by, F.col(value).cast("string").alias("_key")).where("_key is not null").distinct()
    known = folded.join(ids, "_key")
    bucket = F.bitmap_bucket_number("_id").alias("bucket")
    return known.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """Bitmaps of coarser groups: the OR of the finer ones."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bits(bitmaps: DataFrame, *by: str, name: str = "num") -> DataFrame:
    """The number of distinct values of each group."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's data files; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", "*.parquet").load(path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
