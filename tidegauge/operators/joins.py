"""Joins of a large fact table with a dimension.

No size hint is given: Spark broadcasts a dimension whose size it knows to be
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges,
and then AQE splits the reduce partition of a hot key. What AQE should not have to
repair are rows without a key, which would all hash to one reducer; they are
spread here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_lookup_key"
_SPREAD = "_spread_key"
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    *values: str,
    spread_by: Sequence[str] = (),
    latest: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Adds ``values`` of the dimension row with the same ``key``; NULL when there is none.

    A key that the dimension repeats counts once: its values are those of the row that ``latest``
    puts last, or without it of the greatest row, so a repeated key never multiplies facts. A table that has
    each key once by contract needs no such fold: ``unique`` saves its shuffle.
    A fact key that is no number finds nothing in a numeric dimension. Rows without a key are spread by a hash of
    ``spread_by`` (all columns, if not given): a hash and not a random number, so a
    task that runs again gives the same rows.
    """
    kind = "bigint" if dict(dim.dtypes)[key] in _WHOLE else "string"
    rank = [latest] if latest else []
    row = F.struct(*rank, *(v for v in values if v not in rank))
    # Grouped by a struct, so that the join shuffles both sides for itself: AQE splits a hot key
    # only there, and not above an aggregate that is partitioned by the join's own key.
    known = dim.where(F.col(key).isNotNull())
    if unique:
        keyed = known.select(F.col(key).cast(kind).alias(_KEY), *values)
    else:
        keyed = known.groupBy(F.struct(F.col(key).cast(kind).alias("k")).alias(_KEY))
        keyed = keyed.agg(F.max(row).alias("_row"))
        keyed = keyed.select(F.col(_KEY)["k"].alias(_KEY), *(F.col("_row")[v].alias(v) for v in values))
    nobody = F.xxhash64(*(spread_by or facts.columns)).cast(kind)
    spread = facts.withColumn(_SPREAD, F.coalesce(F.col(key).try_cast(kind), nobody))
    # The second condition keeps a hash from matching a key by accident.
    match = (F.col(_SPREAD) == F.col(_KEY)) & spread[key].try_cast(kind).isNotNull()
    return spread.join(keyed, match, "left").drop(_SPREAD, _KEY)


def keep_matching(facts: DataFrame, dim: DataFrame, *on: str) -> DataFrame:
    """Rows of ``facts`` with a partner in ``dim``; keyless rows are dropped before the shuffle."""
    known = facts.dropna(subset=list(on))
    return known.join(dim.select(*on), list(on), "left_semi")
