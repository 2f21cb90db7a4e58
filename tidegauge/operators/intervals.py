"""Joins of facts at an instant with intervals of validity, at full precision and with open ends.

Intervals get a level by their length, each level's bins being ``STEP`` times as wide as the last one's,
and are listed under the at most two bins of their level that they touch; a fact is looked for in one
bin of every level in use. So the join is an equality on key, level and bin, with the exact range as a
remaining condition. The widths come from the data: only levels of lengths that occur are used,
never more than ``LEVELS``. An interval without start or end has a level of its own, whose key is the fact's
alone.

A busy key is spread over its bins, and is split at run time where one bin is still large, as neither
side of the join is an aggregate.

Pairs of facts and intervals grow with the square of a key's rows. Where only their number and the highest
value are wanted, :func:`covering` counts them without making them, see :func:`_counted`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ratio of the widths of neighbouring levels, and of the narrowest bins to a microsecond.
STEP = 8
LEVELS = 21  # 8 ** 21 microseconds is more than all of time
OPEN = -1
_LEVEL, _BIN = "_level", "_bin"


def micros(time: Column | str) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def merged(intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """``(keys, start, end)``: overlapping or touching intervals of a key as one; ends are included.

    A missing start or end is open. Intervals that end before they start are dropped.
    """
    first = F.coalesce(micros(start), F.lit(-(1 << 63) + 1))
    last = F.coalesce(micros(end), F.lit((1 << 63) - 2))
    spans = intervals.select(*keys, first.alias("_a"), last.alias("_b")).where("_a <= _b").dropna(subset=list(keys))
    spans = spans.groupBy(*keys, "_a").agg(F.max("_b").alias("_b"))
    order = Window.partitionBy(*keys).orderBy("_a")
    reach = F.max("_b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", F.coalesce(F.col("_a") > reach + 1, F.lit(True)).cast("int"))
    islands = islands.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy(*keys, "_island").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    begun = F.when(F.col("_a") > -(1 << 63) + 1, F.timestamp_micros("_a"))
    over = F.when(F.col("_b") < (1 << 63) - 2, F.timestamp_micros("_b"))
    return whole.select(*keys, begun.alias(start), over.alias(end))


def level_of(start: Column, end: Column) -> Column:
    """The level whose bins are the narrowest that an interval of this length spans two of at most."""
    length = end - start + 1
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(length <= STEP**k, k).otherwise(level)
    return F.when(start.isNull() | end.isNull(), OPEN).otherwise(level).cast("int")


def _width(level: Column) -> Column:
    return F.element_at(F.array(*(F.lit(STEP**k).cast("bigint") for k in range(LEVELS))), level + 1)


def _bin_of(time: Column, level: Column) -> Column:
    return F.when(level == OPEN, F.lit(0).cast("bigint")).otherwise(F.floor(time / _width(F.greatest(level, F.lit(0)))))


def listed(intervals: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals under each bin that they touch, ``_level`` and ``_bin``; columns stay."""
    a, b = micros(start), micros(end)
    kept = intervals.where(a.isNull() | b.isNull() | (a <= b)).withColumn(_LEVEL, level_of(a, b))
    level = F.col(_LEVEL)
    bins = F.when(level == OPEN, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.sequence(_bin_of(a, level), _bin_of(b, level))
    )
    return kept.withColumn(_BIN, F.explode(bins))


def levels_in_use(bins: DataFrame) -> list[int]:
    """At most ``LEVELS`` + 1 numbers, whatever the table's size."""
    return sorted(row[0] for row in bins.select(_LEVEL).distinct().collect())


def probed(facts: DataFrame, at: str, levels: Sequence[int]) -> DataFrame:
    """Facts under the bin of each level that may hold an interval around their time."""
    time = micros(at)
    places = [F.struct(F.lit(k).alias(_LEVEL), _bin_of(time, F.lit(k)).alias(_BIN)) for k in levels]
    if not places:
        return facts.withColumns({_LEVEL: F.lit(None).cast("int"), _BIN: F.lit(None).cast("bigint")}).limit(0)
    each = facts.where(F.col(at).isNotNull()).withColumn("_place", F.explode(F.array(*places)))
    return each.withColumns({_LEVEL: F.col("_place")[_LEVEL], _BIN: F.col("_place")[_BIN]}).drop("_place")


def covering(
    facts: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str = "ts",
    start: str = "start",
    end: str = "end",
    how: str = "inner",
    value: str | None = None,
) -> DataFrame:
    """Facts with every interval of their key that holds at their time, both ends included.

    ``how`` is ``inner``, or ``left_semi`` for facts that some interval covers; for the latter the
    intervals of a key should be disjoint (:func:`merged`), else a fact comes once for each level it
    is covered on. Facts without key or time meet none. The interval's columns that facts have too,
    keys aside, must be renamed before.

    With ``how="count"`` no pairs are made: facts that some interval covers come with ``n``, the number of
    such intervals, and ``highest``, the highest ``value`` of them. A fact may come in several rows, one for each level
    that it is covered on: add up ``n`` and take the highest ``highest``.
    """
    if how == "count":
        return _counted(facts, intervals, list(keys), at, start, end, value)
    bins = listed(intervals.dropna(subset=list(keys)), start, end)
    wanted = [*keys, _LEVEL, _BIN]
    left = probed(facts.dropna(subset=list(keys)), at, levels_in_use(bins)).alias("f")
    right = bins.alias("i")
    same = F.lit(True)
    for name in wanted:
        same = same & (F.col(f"f.{name}") == F.col(f"i.{name}"))
    time, a, b = F.col(f"f.{at}"), F.col(f"i.{start}"), F.col(f"i.{end}")
    inside = (a.isNull() | (a <= time)) & (b.isNull() | (time <= b))
    met = left.join(right, same & inside, how)
    if how == "left_semi":
        return met.select(*facts.columns)
    added = [F.col(f"i.{c}").alias(c) for c in intervals.columns if c not in keys]
    return met.select(*(F.col(f"f.{c}").alias(c) for c in facts.columns), *added)


#: Level of the slices of time, 2.4 hours wide.
SLICE = 11
_TIME, _N, _HIGHEST, _FACT = "_time", "_n", "_highest", "_fact"
_FIRST, _LAST = -(1 << 62), (1 << 62) - 1  # before and after all times


def _shifted(time: Column, level: Column | int) -> Column:
    """The bin of a time, exactly; the level may differ by row."""
    return F.call_function("shiftright", time, F.lit(level) * 3)  # 8 is 2 ** 3


def _level_apart(a: Column, b: Column) -> Column:
    """The highest level up to ``SLICE`` on which two times are in different bins; 0 for one time."""
    level = F.lit(0)
    for k in range(1, SLICE + 1):
        level = F.when(_shifted(a, k) != _shifted(b, k), k).otherwise(level)
    return level


def _covers(first: Column, last: Column) -> Column:
    """``(level, bin)`` of the widest bins, from ``SLICE`` up, that make up the slices ``first`` to ``last``."""

    def span(low: Column, high: Column) -> Column:
        bins = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(bins, lambda x: F.struct(F.lit(level).alias(_LEVEL), x.alias(_BIN)))

    parts = []
    for level in range(SLICE, LEVELS - 1):
        above, below = _shifted(first + STEP - 1, 1), _shifted(last + 1, 1) - 1
        head = F.least(last, above * STEP - 1)
        parts += [span(first, head), span(F.greatest(head + 1, (below + 1) * STEP), last)]
        first, last = above, below
    level = LEVELS - 1
    return F.flatten(F.array(*parts, span(first, last)))


def _counted(
    facts: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, value: str | None
) -> DataFrame:
    """Number and highest value of the intervals around each fact; rows grow with the input, not with pairs.

    An interval's two ends are put into their bins on the highest level where these differ. In the first
    bin it covers the facts from its start on, in the last one those up to its end, and bins between it
    covers whole. So running sums and maxima over the ends in a bin, forwards over starts and backwards
    over ends, tell what a fact meets there. No level is above ``SLICE``: what covers slices whole is put
    into the few widest bins that make them up, and each slice with facts adds up the bins around it. So a
    key is dealt out over its slices of time, however long its intervals are; facts of one key and slice
    are sorted by one task.
    """
    a, b = F.coalesce(micros(start), F.lit(_FIRST)), F.coalesce(micros(end), F.lit(_LAST))
    highest = F.col(value) if value else F.lit(None).cast("double")
    spans = intervals.dropna(subset=keys).select(*keys, a.alias("_a"), b.alias("_b"), highest.alias(_HIGHEST))
    spans = spans.where("_a <= _b").withColumn(_LEVEL, _level_apart(F.col("_a"), F.col("_b")))
    own, sums = F.col(_LEVEL), [F.sum(_N).alias(_N), F.max(_HIGHEST).alias(_HIGHEST)]
    spans = spans.groupBy(*keys, _LEVEL, "_a", "_b").agg(F.count(F.lit(1)).alias(_N), F.max(_HIGHEST).alias(_HIGHEST))
    low, high = _shifted(F.col("_a"), own), _shifted(F.col("_b"), own)
    place = [*keys, _LEVEL, _BIN]

    starts = spans.where(F.col("_a") != _FIRST).select(*keys, _LEVEL, low.alias(_BIN), F.col("_a").alias(_TIME), _N, _HIGHEST)
    # One instant is met at its start alone.
    ends = spans.where((F.col("_b") != _LAST) & (F.col("_a") < F.col("_b")))
    ends = ends.select(*keys, _LEVEL, high.alias(_BIN), F.col("_b").alias(_TIME), _N, _HIGHEST)

    between = F.transform(F.sequence(low, high), lambda x: F.struct(own.alias(_LEVEL), x.alias(_BIN)))
    between = F.filter(between, lambda x: (x[_BIN] > low) & (x[_BIN] < high))
    held = F.when(own < SLICE, between).otherwise(_covers(low + 1, high - 1))
    whole = spans.select(*keys, F.explode(held).alias("_place"), _N, _HIGHEST)
    whole = whole.select(*keys, f"_place.{_LEVEL}", f"_place.{_BIN}", _N, _HIGHEST).groupBy(*place).agg(*sums)

    known = facts.dropna(subset=[*keys, at])
    slices = known.select(*keys, _shifted(micros(at), SLICE).alias("_slice")).distinct()
    around = F.array(*(
        F.struct(F.lit(k).alias(_LEVEL), _shifted(F.col("_slice"), k - SLICE).alias(_BIN)) for k in range(SLICE, LEVELS)
    ))
    around = slices.select("*", F.explode(around).alias("_place"))
    around = around.select(*keys, "_slice", f"_place.{_LEVEL}", f"_place.{_BIN}").join(whole, place)
    carried = around.groupBy(*keys, F.lit(SLICE).alias(_LEVEL), F.col("_slice").alias(_BIN)).agg(*sums)
    carried = carried.unionByName(whole.where(own < SLICE)).withColumn(_TIME, F.lit(_FIRST))

    levels = sorted({SLICE, *levels_in_use(spans)})
    probes = F.array(*(F.struct(F.lit(k).alias(_LEVEL), _shifted(micros(at), k).alias(_BIN)) for k in levels))
    asked = known.select(*keys, micros(at).alias(_TIME), F.struct(*facts.columns).alias(_FACT), F.explode(probes).alias("_place"))
    asked = asked.select(*keys, f"_place.{_LEVEL}", f"_place.{_BIN}", _TIME, _FACT)
    met = asked
    for rows, side in ((starts.unionByName(carried), "from"), (ends, "to")):
        rows = rows.withColumnsRenamed({_N: f"{_N}_{side}", _HIGHEST: f"{_HIGHEST}_{side}"})
        met = met.unionByName(rows, allowMissingColumns=True)
    found = {}
    for side, time in (("from", F.col(_TIME).asc()), ("to", F.col(_TIME).desc())):
        # At one time ends come before facts, whose struct is not null.
        order = Window.partitionBy(*place).orderBy(time, F.col(_FACT).isNotNull())
        running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found[f"{_N}_{side}"] = F.coalesce(F.sum(f"{_N}_{side}").over(running), F.lit(0))
        found[f"{_HIGHEST}_{side}"] = F.max(f"{_HIGHEST}_{side}").over(running)
    met = met.withColumns(found).where(F.col(_FACT).isNotNull())
    return met.select(
        *(F.col(f"{_FACT}.{c}").alias(c) for c in facts.columns),
        (F.col(f"{_N}_from") + F.col(f"{_N}_to")).alias("n"),
        F.greatest(f"{_HIGHEST}_from", f"{_HIGHEST}_to").alias("highest"),
    ).where("n > 0")


def keep_covered(
    facts: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str = "ts",
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Facts that some interval of their key covers, each once, however many overlap there."""
    return covering(facts, merged(intervals, keys, start, end), keys, at, start, end, "left_semi")
