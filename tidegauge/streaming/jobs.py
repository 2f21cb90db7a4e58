"""The streams: archives, page views, promotion counters, running distinct and word counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidegauge.functions.labels import REGION_CODES, region_code
from tidegauge.functions.text import request_target, words
from tidegauge.functions.timebuckets import (
    DAY_KEY,
    bucket,
    date_of_millis,
    date_of_seconds,
    day_of,
    time_text,
)
from tidegauge.operators.filters import is_promo_click, not_openapi, promo_code
from tidegauge.operators.metrics import count_by, fold, page_views
from tidegauge.plans.jobs import enriched_log
from tidegauge.sources.access_log import parse_lines
from tidegauge.sources.app_events import (
    REASONS,
    parse_behaviour,
    parse_behaviour_variant,
    parse_events,
    parse_events_observed,
)
from tidegauge.sources.archive import with_partitions
from tidegauge.streaming.sinks import Sink, aggregated, append_batch, both


def start(
    stream: DataFrame,
    sink: Sink,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Runs a stream into a batch sink, resuming from ``checkpoint`` if it exists.

    ``every`` is a trigger interval; without it all data there is now is taken
    and the query ends.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.foreachBatch(sink).trigger(**trigger).start()


def run(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append") -> None:
    """Takes all data there is now and waits until it is stored."""
    start(stream, sink, checkpoint, mode=mode).awaitTermination()


def promo_clicks(lines: DataFrame, tz: str = "UTC") -> DataFrame:
    """``(day, site, r)`` of the page requests that carry a promotion code."""
    clicks = parse_lines(lines).where(is_promo_click() & F.col("ts").isNotNull())
    return clicks.select(
        time_text("ts", DAY_KEY, tz).alias("day"),
        "site",
        promo_code(request_target("request")).alias("r"),
        "connection",
    ).where(F.col("r").isNotNull())


def promo_counts(lines: DataFrame, tz: str = "UTC") -> DataFrame:
    return count_by(promo_clicks(lines, tz), "day", "site", "r")


def visitors(
    log: DataFrame, value: str = "member_id", ts: str = "ts", tz: str = "UTC"
) -> DataFrame:
    """``(dt, created, value, ts)`` per hit, for :func:`first_seen`."""
    seen = log.where(F.col(value).isNotNull())
    hour = bucket(ts, "hour", tz).alias("created")
    return seen.select(day_of(ts, tz).alias("dt"), hour, value, F.col(ts).alias("ts"))


def word_counts(text: Column | str, df: DataFrame) -> DataFrame:
    """Count per word; on a stream, a running count held in the state store."""
    return count_by(df.select(F.explode(words(text)).alias("word")), "word")


def windowed_page_views(log: DataFrame, delay: str, region: str = "region_code") -> DataFrame:
    """Page views per second and region, final once ``delay`` has passed.

    Rows later than that are dropped, which the additive counters never do.
    """
    second = F.window("ts", "1 second")
    counted = log.withWatermark("ts", delay).groupBy(second, F.col(region).alias("region"))
    created = F.unix_seconds("window.start").alias("created")
    return counted.agg(F.count(F.lit(1)).alias("num")).select(created, "region", "num")


def first_seen(log: DataFrame, delay: str, *keys: str, splits: int | None = None) -> DataFrame:
    """Rows whose keys have not been seen within ``delay``; the state stays bounded.

    A stream has no partial aggregate to shrink a busy key before the shuffle.
    So its rows are first told apart within ``splits`` shares (as many as shuffle
    partitions, if not given), by a hash of the row, and only the first of each
    share goes on to the task of the key.
    """
    splits = splits or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64(*log.columns), F.lit(splits))
    shared = log.withColumn("_share", share).withWatermark("ts", delay)
    few = shared.dropDuplicatesWithinWatermark([*keys, "_share"])
    return few.dropDuplicatesWithinWatermark(list(keys)).drop("_share")


def access_sink(
    dimensions: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
    archive: str,
    counters: str,
    codes: Mapping[str, str] = REGION_CODES,
    partitions: Sequence[str] = ("dt", "hr"),
    tz: str = "UTC",
) -> Sink:
    """Raw lines of a batch to the enriched archive and to page views per second and region.

    Both outputs take one enriched batch. ``dimensions`` gives geography and sessions and is
    called for every batch, so that a batch sees sessions that began after the stream did.
    """

    def page_view_counts(log: DataFrame) -> DataFrame:
        coded = log.where(not_openapi()).withColumn("region_code", region_code("region", codes))
        views = page_views(fold(coded, "second", "region_code"))
        return views.withColumn("dt", date_of_seconds("created", tz))

    outputs = both(
        append_batch(archive, *partitions),
        aggregated(page_view_counts, append_batch(counters, "dt")),
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        log = enriched_log(batch, *dimensions(batch.sparkSession))
        outputs(with_partitions(log, tz=tz), batch_id)

    return write


def app_event_sink(archive: str, tz: str = "UTC") -> Sink:
    """App events of a batch, stored by event day."""
    stored = append_batch(archive, "dt")
    return lambda batch, batch_id: stored(
        parse_events(batch).withColumn("dt", day_of("ts", tz)), batch_id
    )


def counted_event_sink(archive: str, rejects: str, tz: str = "UTC") -> Sink:
    """:func:`app_event_sink` that also stores, per batch, how many lines came and why lines were dropped.

    The counts are observed while the batch is written; its lines are not read a second time. The write
    has no shuffle: where one finds nothing to deal out, Spark leaves out what comes after it at run
    time, and the counts of a batch without good lines would be lost.
    """
    stored, counted = append_batch(archive, "dt", balanced=False), append_batch(rejects)

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        events = parse_events_observed(batch, seen)
        stored(events.withColumn("dt", day_of("ts", tz)), batch_id)
        names = {"lines": "lines", "kept": "kept", **REASONS}
        rows = [(names[name], n) for name, n in seen.get.items()]
        counted(batch.sparkSession.createDataFrame(rows, "reason string, num bigint"), batch_id)

    return write


def behaviour_variant_sink(archive: str, tz: str = "UTC") -> Sink:
    """Behaviour events of a batch with their payload as VARIANT, stored by event day."""
    stored = append_batch(archive, "dt")
    return lambda batch, batch_id: stored(
        parse_behaviour_variant(batch).withColumn("dt", date_of_millis("mtime", tz)), batch_id
    )


def behaviour_sink(archive: str, tz: str = "UTC") -> Sink:
    """Behaviour events of a batch as they came, stored by event day."""
    stored = append_batch(archive, "dt")
    return lambda batch, batch_id: stored(
        parse_behaviour(batch).withColumn("dt", date_of_millis("mtime", tz)), batch_id
    )
