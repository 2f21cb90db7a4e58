"""As-of join: each fact with the row of a history that holds at the fact's own time.

Both sides are put into one table, and a running window carries the last history row of a key forward
to the facts after it, so no range condition ever pairs rows. A key's time is cut into slices: the last
history row before a slice is carried into it, from one small row per key and slice. A key with a large
share of all facts is thus many groups; a slice of it that is still large is dealt out by a hash of its
facts, each share with a copy of the slice's history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 6 * 3600
#: Facts of one key and slice that one task sorts together.
GROUP_ROWS = 200_000
_OWN = "_asof_"


def _name(part: str) -> str:
    return f"{_OWN}{part}"


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    values: Sequence[str],
    at: str = "ts",
    since: str = "since",
    until: str | None = None,
    slice_seconds: int = SLICE_SECONDS,
    group_rows: int = GROUP_ROWS,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Adds ``values`` of the history row with the fact's key that began last, at the fact's time or before.

    NULL where there is none, where that row's ``until`` is not after the fact's time (a row without one
    holds until the next), and for facts without key or time. Of rows that begin at the same
    time the greatest counts. A history row without key or start is left out.
    """
    key_, slice_, share, when, row, fact = map(_name, ("key", "slice", "share", "when", "row", "fact"))
    of = [key_, slice_]

    def micros(time: str) -> Column:
        return F.unix_micros(F.col(time).cast("timestamp"))

    def slice_of(time: Column) -> Column:
        return F.floor(time / F.lit(slice_seconds * 1_000_000))

    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    timed = facts.where(known).withColumns({key_: F.col(key), when: micros(at), slice_: slice_of(micros(at))})
    sizes = timed.groupBy(*of).agg(F.count(F.lit(1)).alias("n"))
    shares = F.ceil(F.col("n") / F.lit(group_rows)).cast("int")
    # Grouped by a struct below, so that AQE can split a hot key in the join with its number of shares.
    large = sizes.where(F.col("n") > group_rows).select(
        F.struct(*of).alias("of"), shares.alias("shares")
    )
    large = large.select(*(F.col(f"of.{c}").alias(c) for c in of), "shares")
    own = list(spread_by or facts.columns)
    dealt = timed.join(large, of, "left").withColumn(
        share, F.pmod(F.xxhash64(*own), F.coalesce("shares", F.lit(1))).cast("int")
    )

    payload = F.struct(*([micros(until).alias("until")] if until else []), *values)
    begun = history.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    begun = begun.groupBy(F.col(key).alias(key_), micros(since).alias(when)).agg(F.max(payload).alias(row))
    begun = begun.withColumn(slice_, slice_of(F.col(when)))

    # The last row of every slice, carried into the later slices that have facts.
    last = begun.groupBy(*of).agg(F.max(F.struct(when, row)).alias("last"), F.lit(0).alias("asked"))
    asked = sizes.select(*of, F.lit(None).cast(last.schema["last"].dataType).alias("last"), F.lit(1).alias("asked"))
    touched = last.unionByName(asked).groupBy(*of).agg(F.max("last").alias("last"), F.max("asked").alias("asked"))
    earlier = Window.partitionBy(key_).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.withColumn("last", F.last("last", ignorenulls=True).over(earlier))
    carried = carried.where((F.col("asked") == 1) & F.col("last").isNotNull())
    carried = carried.select(*of, F.col(f"last.{when}").alias(when), F.col(f"last.{row}").alias(row))

    held = begun.select(*of, when, row).unionByName(carried)
    held = held.join(sizes.select(*of), of, "left_semi").join(large, of, "left")
    held = held.withColumn(share, F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)))

    whole = F.struct(*facts.columns)
    none = F.lit(None)
    both = dealt.select(*of, share, when, none.cast(held.schema[row].dataType).alias(row), whole.alias(fact))
    both = both.unionByName(
        held.select(*of, share, when, row, none.cast(both.schema[fact].dataType).alias(fact))
    )
    # At one time history comes before facts, whose struct is not null.
    order = Window.partitionBy(*of, share).orderBy(when, F.col(fact).isNotNull())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(row, F.last(row, ignorenulls=True).over(running)).where(F.col(fact).isNotNull())
    holds = F.lit(True) if until is None else F.coalesce(F.col(f"{row}.until") > F.col(when), F.lit(True))
    added = [F.when(holds, F.col(f"{row}.{v}")).alias(v) for v in values]
    found = found.select(*(F.col(f"{fact}.{c}").alias(c) for c in facts.columns), *added)
    kinds = {v: history.schema[v].dataType for v in values}
    rest = facts.where(~known).select("*", *(none.cast(kinds[v]).alias(v) for v in values))
    return found.unionByName(rest)
