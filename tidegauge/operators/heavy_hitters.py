"""The most frequent keys, exactly, from sketches of bounded size.

Each day (or any part) is folded into a frequent-items sketch of at most ``tracked`` items, and sketches of
parts combine into one of the whole. A sketch of N rows gives its candidates, and bounds what it may have
missed: no other key has more than ``2 * 3.5 * N / slots`` rows, where its table has ``slots`` places. Rows of the
candidates are counted exactly. If the n-th count is above the bound, these are the top n; if the data
do not part that clearly, every key is counted.

Keys enter the sketch as a 64-bit hash of all key columns. A collision can only add a candidate, whose
keys the recount tells apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.metrics import count_by, top_keys

#: Items of a sketch; the state of a group, some hundred kB.
TRACKED = 10_000
#: Of the sketch: its error is at most this share of the rows, divided by its slots.
ERROR, LOAD = 3.5, 0.75


def slots_of(tracked: int) -> int:
    """Places in the table of a sketch: a power of two that is filled to three quarters."""
    return 1 << max(3, (-(-int(tracked / LOAD) // 1) - 1).bit_length())


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def sketches(df: DataFrame, keys: Sequence[str], *by: str | Column, tracked: int = TRACKED) -> DataFrame:
    """``(by, sketch, rows)`` for each group; store these, a row per day."""
    hashed = df.withColumn("_hash", key_hash(keys))
    sketch = F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("sketch")
    return hashed.groupBy(*by).agg(sketch, F.count(F.lit(1)).alias("rows"))


def combined(parts: DataFrame, *by: str | Column, tracked: int = TRACKED) -> DataFrame:
    """Sketches of coarser groups."""
    sketch = F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    return parts.groupBy(*by).agg(sketch, F.sum("rows").alias("rows"))


def candidates(whole: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``_hash`` of the items that a sketch is sure of, at most ``tracked`` for each row."""
    found = F.expr(f"approx_top_k_estimate(sketch, {tracked})")
    return whole.select(F.explode(found).alias("e")).select(F.col("e.item").alias("_hash"))


def missed_at_most(rows: int, tracked: int = TRACKED) -> float:
    """Rows that a key outside the candidates may have: its upper bound where its lower one is no more than the
    largest error."""
    return 2 * ERROR * rows / slots_of(tracked)


def top_keys_bounded(
    df: DataFrame, n: int, *keys: str, parts: DataFrame | None = None, tracked: int = TRACKED
) -> DataFrame:
    """The ``n`` most frequent keys with their counts; equal counts in key order.

    ``parts`` are stored :func:`sketches` of ``df``; without them they are made here.
    """
    if parts is None:
        parts = sketches(df, keys, tracked=tracked)
    whole = combined(parts, tracked=tracked)
    rows = whole.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
    # At most `tracked` numbers of eight bytes, so they may be broadcast.
    sure = F.broadcast(candidates(whole, tracked))
    few = df.withColumn("_hash", key_hash(keys)).join(sure, "_hash", "left_semi")
    counted = top_keys(count_by(few, *keys), n, *keys)
    least = counted.agg(F.count(F.lit(1)).alias("found"), F.min("num").alias("num")).first()
    if least["found"] == n and least["num"] > missed_at_most(rows, tracked):
        return counted
    return top_keys(count_by(df, *keys), n, *keys)
