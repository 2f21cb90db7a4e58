"""Report tables: replacing and additive merges by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_replace(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Target rows with the updates' values put over them, and new rows added.

    Both tables have one row per key. Value columns the updates do not carry are
    kept, so jobs may fill different columns of one row. Applying the same updates
    twice changes nothing.
    """
    rest = [c for c in target.columns if c not in keys]
    stale = target.withColumn("_fresh", F.lit(False))
    fresh = updates.select(*keys, *values).withColumn("_fresh", F.lit(True))
    both = stale.unionByName(fresh, allowMissingColumns=True)
    old = {c: F.max(F.when(~F.col("_fresh"), F.col(c))) for c in rest}
    new = {c: F.max(F.when(F.col("_fresh"), F.col(c))) for c in rest}
    merged = [(F.coalesce(new[c], old[c]) if c in values else old[c]).alias(c) for c in rest]
    return both.groupBy(*keys).agg(*merged)


def merge_add(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Sum of both tables' counters by key; a key or counter missing in one counts as 0."""
    both = target.select(*keys, *values).unionByName(
        updates.select(*keys, *values), allowMissingColumns=True
    )
    sums = [F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v) for v in values]
    return both.groupBy(*keys).agg(*sums)
