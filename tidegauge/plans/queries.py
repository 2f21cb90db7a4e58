"""Every operator as a query over the driver's tables: ``name -> f(spark, sf_dir)``.

Dates leave a query as text or epoch seconds, so that engines agree on them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import asof, labels, text, timebuckets
from tidegauge.functions.ids import descramble, scramble
from tidegauge.operators import apps, cohort, enrich, filters, key_sets, metrics, tables
from tidegauge.plans import adapters as a
from tidegauge.plans import jobs
from tidegauge.schemas import IDENTITY_FIELDS, REPORTS
from tidegauge.session import shared_dir
from tidegauge.sources import access_log, app_events, archive, lookups
from tidegauge.streaming import jobs as stream_jobs
from tidegauge.streaming import sinks
from tidegauge.streaming.sources import table_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2024, 1, 30)
# The replayed table is in no order of time, so no event may be too late.
LATENESS = "400 days"
SPLIT = datetime(2024, 1, 16, 12)
SPLIT_DAY = date(2024, 1, 16)
COHORT_END = datetime(2024, 1, 11, tzinfo=timezone.utc)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _day_text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _halves() -> tuple[Column, Column]:
    """Events before and from the split time."""
    split = timebuckets.wall_clock(SPLIT)
    return F.col("ts") < split, F.col("ts") >= split


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return a.table(spark, sf, "events")


# --- scans and filters -----------------------------------------------------------


@query
def scan_day_range(spark, sf):
    in_range = archive.between_days("ts", date(2024, 1, 5), date(2024, 1, 7))
    log = a.as_hits(_events(spark, sf).where(in_range))
    return log.select("event_id", "site", "ip", timebuckets.bucket("ts", "second").alias("created"))


@query
def scan_last_hour(spark, sf):
    """As of the newest event: the full hour before it."""
    events = _events(spark, sf)
    newest = events.agg(F.max("ts")).first()[0]
    hour = asof.last_hour(newest)
    return a.as_hits(events.where(archive.in_hour("ts", hour))).select("event_id", "site", "ip")


@query
def valid_identity(spark, sf):
    log = a.with_org(a.hits(spark, sf).where(filters.not_openapi()), a.users(spark, sf))
    return log.where(filters.has_identity()).select("event_id", *IDENTITY_FIELDS)


@query
def drop_internal(spark, sf):
    return a.hits(spark, sf).where(~filters.is_lan("net")).select("event_id", "ip", "net")


@query
def request_filter(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    kept = parsed.where(filters.is_business_request())
    return kept.select("connection", "site", "request", "n_fields")


@query
def promo_clicks(spark, sf):
    return stream_jobs.promo_clicks(a.lines(spark, sf)).withColumnRenamed("connection", "event_id")


@query
def promo_counts(spark, sf):
    return stream_jobs.promo_counts(a.lines(spark, sf))


# --- parsing and scalars ---------------------------------------------------------


@query
def parse_access_log(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    return parsed.select(
        "connection",
        "remote_addr",
        "server_addr",
        "site",
        "connection_requests",
        "request_length",
        timebuckets.bucket("ts", "second").alias("created"),
        (F.col("msec") * 1000).cast("bigint").alias("msec_ms"),
        "request",
        "request_args",
        "status",
        "body_bytes_sent",
        "bytes_sent",
        "http_user_agent",
        F.round(F.col("request_time") * 1000).cast("bigint").alias("request_ms"),
        F.round(F.col("upstream_response_time") * 1000).cast("bigint").alias("upstream_ms"),
        "sent_http_set_cookie",
        "n_fields",
    )


@query
def parse_enriched_log(spark, sf):
    """Enriched text lines read back: missing ids come as the word for it, and become NULL."""
    log = a.hits(spark, sf)
    rows = log.select(
        "site", "ip", "event_id", "member_id", "qz_id", "user_id", "bytes_sent", "net", "has_org", "k"
    ).withColumns(
        {
            "country": F.col("net"),
            "region": F.lit(None).cast("string"),
            "city": F.col("site"),
            "instance_id": F.when(F.col("has_org"), F.col("k").cast("string")),
        }
    )
    fields = {name: F.lit("-") for name, _ in access_log.ACCESS_FIELDS}
    fields |= {
        "remote_addr": F.col("ip"),
        "site": F.col("site"),
        "connection": F.col("event_id"),
        "bytes_sent": F.col("bytes_sent"),
    }
    line = access_log.render_enriched_line(access_log.render_line(fields))
    parsed = access_log.parse_enriched_lines(rows.select(line.alias("value")))
    return parsed.select(
        F.col("connection").alias("event_id"),
        "n_fields",
        "site",
        "country",
        "region",
        "city",
        *IDENTITY_FIELDS,
    )


@query
def extract_token(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    target = text.request_target("request")
    return enrich.with_session(parsed).select(
        F.col("connection").alias("event_id"),
        text.args_token("request_args").alias("args_token"),
        text.url_param(target, "access_token").alias("access_token"),
        text.url_param(target, "token").alias("token"),
        "session",
        text.is_usable_token("session").alias("usable"),
    )


@query
def extract_session(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    return parsed.select(
        F.col("connection").alias("event_id"),
        text.session_cookie("sent_http_set_cookie").alias("session"),
    )


@query
def url_param(spark, sf):
    pages = a.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        text.url_param("url", "page").alias("page"),
        text.url_param("url", "ref").alias("ref"),
    )


@query
def openapi_ids(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf)).where(F.col("site") == "openapi")
    known = enrich.with_open_ids(parsed)
    return known.select(F.col("connection").alias("event_id"), "n_fields", *enrich.OPEN_IDS)


@query
def id_descramble(spark, sf):
    scrambled = _events(spark, sf).select("event_id", scramble("event_id").alias("scrambled"))
    return scrambled.select(
        "*", descramble("event_id").alias("descrambled"), descramble("scrambled").alias("back")
    )


@query
def regex_extract(spark, sf):
    return a.lines(spark, sf).select(
        text.first_match("value", text.IPV4).alias("ip"),
        text.first_match("value", text.SESSION_26).alias("session"),
        text.first_match("value", text.TOKEN_40).alias("token"),
    )


@query
def classify_request(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    app_id = labels.app_of_request("request").alias("app_id")
    return parsed.select(F.col("connection").alias("event_id"), "request", app_id)


@query
def region_code(spark, sf):
    code = labels.region_code("region", a.AREA_CODES)
    return a.located_users(spark, sf).select("custkey", "region", code.alias("code"))


@query
def client_class(spark, sf):
    return a.hits(spark, sf).select(
        "event_id", labels.client_class("user_agent").alias("client")
    )


@query
def int_or_zero(spark, sf):
    return a.hits(spark, sf).select(
        "event_id", "bytes_sent", text.int_or_zero("bytes_sent").alias("n")
    )


@query
def time_buckets(spark, sf):
    units = [timebuckets.bucket("ts", u).alias(u) for u in timebuckets.UNITS]
    return a.hits(spark, sf).select(
        "event_id",
        *units,
        timebuckets.bucket("ts", "day", "Asia/Shanghai").alias("day_shanghai"),
        timebuckets.bucket("ts", "month", "Asia/Shanghai").alias("month_shanghai"),
        timebuckets.millis("ts").alias("ms"),
        timebuckets.bucket_of_millis(timebuckets.millis("ts"), "day").alias("day_of_ms"),
    )


def _period_starts(spark, sf, unit):
    day = timebuckets.day_of("ts")
    start = timebuckets.period_start(day, unit)
    starts = a.hits(spark, sf).select(day.cast("string").alias("day"), start.alias("start"))
    epoch = timebuckets.day_epoch("start").alias("created")
    return starts.distinct().select("day", _day_text("start"), epoch)


@query
def week_start(spark, sf):
    return _period_starts(spark, sf, "week")


@query
def month_start(spark, sf):
    return _period_starts(spark, sf, "month")


@query
def time_compare(spark, sf):
    """Each event against the noon of its day."""
    noon = F.timestamp_seconds(timebuckets.bucket("ts", "day") + 12 * timebuckets.HOUR)
    second = F.timestamp_seconds(timebuckets.bucket("ts", "second"))
    return a.hits(spark, sf).select(
        "event_id",
        timebuckets.is_before(second, noon).cast("int").alias("before_noon"),
        timebuckets.is_after(second, noon).cast("int").alias("after_noon"),
        timebuckets.seconds_between(second, noon).alias("seconds_from_noon"),
        timebuckets.date_hour_text("ts").alias("date_hour"),
    )


@query
def time_format(spark, sf):
    day = timebuckets.time_text("ts", timebuckets.DAY_TEXT)
    minute = timebuckets.time_text("ts", timebuckets.MINUTE_KEY)
    return a.hits(spark, sf).select(
        "event_id",
        day.alias("day"),
        timebuckets.time_text("ts", timebuckets.DAY_TIME_TEXT).alias("day_time"),
        timebuckets.time_text("ts", timebuckets.DAY_KEY).alias("day_key"),
        minute.alias("minute_key"),
        timebuckets.day_text_epoch(day).alias("day_epoch"),
        timebuckets.time_of_text(minute, timebuckets.MINUTE_KEY).cast("string").alias("parsed"),
    )


# --- enrichment ------------------------------------------------------------------


@query
def geo_enrich(spark, sf):
    log = a.hits(spark, sf).select("event_id", "ip")
    return enrich.with_geo(log, a.geo(a.located_users(spark, sf)), "ip", unique=True)


@query
def identity_enrich(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    known = enrich.with_identity(parsed, a.sessions(a.users(spark, sf)), unique=True)
    return known.select(F.col("connection").alias("event_id"), "n_fields", *IDENTITY_FIELDS)


@query
def enriched_log(spark, sf):
    geo, sessions = a.geo(a.located_users(spark, sf)), a.sessions(a.users(spark, sf))
    log = jobs.enriched_log(a.lines(spark, sf), geo, sessions, unique=True)
    return log.select(
        F.col("connection").alias("event_id"),
        "ip",
        "country",
        *IDENTITY_FIELDS,
        timebuckets.bucket("ts", "second").alias("created"),
    )


@query
def derive_clicks(spark, sf):
    parsed = access_log.parse_lines(a.lines(spark, sf))
    wanted = parsed.where(filters.not_openapi() & enrich.opens_app() & F.col("ts").isNotNull())
    lean = wanted.withColumn("_row", F.xxhash64("value")).drop("value")
    known = enrich.with_identity(lean, a.sessions(a.users(spark, sf)), ["_row"], unique=True)
    valid = known.where(filters.has_identity() & F.col("ts").isNotNull())
    return enrich.derive_clicks(valid).drop("ts")


@query
def lookup_json(spark, sf):
    """Stored lookup replies as dimension rows; every sixth reply is an error."""
    log = a.hits(spark, sf)
    ecode = F.when(F.col("k") % 6 == 0, "1").otherwise("0").alias("ecode")
    identity = F.struct("member_id", "qz_id", "user_id", F.col("site").alias("instance_id"))
    place = F.struct(F.col("net").alias("country"), F.col("site").alias("region"), "user_id")
    app = F.struct(F.col("k").cast("string").alias("open_appid"), F.col("event_type").alias("name"))
    replies = log.select(
        "event_id",
        F.to_json(F.struct(ecode, identity.alias("result"))).alias("identity"),
        F.to_json(F.struct(ecode, F.create_map("ip", place).alias("result"))).alias("geo"),
        F.to_json(F.struct(ecode, app.alias("result"))).alias("app"),
    )
    known = lookups.parse_identity_replies(replies, "identity")
    known = lookups.parse_geo_replies(known, "geo")
    return lookups.parse_app_replies(known, "app").drop("identity", "geo", "app")


# --- page views, visitors, addresses -----------------------------------------------


def region_views(log: DataFrame, people: DataFrame, unit: str = "second") -> DataFrame:
    """Requests per bucket and region code, from an access log without open API and LAN."""
    kept = log.where(filters.not_openapi() & ~filters.is_lan("net"))
    located = a.with_area(metrics.fold(kept, unit, "custkey"), people)
    coded = located.withColumn("region_code", labels.region_code("region", a.AREA_CODES))
    return metrics.page_views(coded)


@query
def pv_second_region(spark, sf):
    return region_views(a.hits(spark, sf), a.located_users(spark, sf))


@query
def pv_region_pivot(spark, sf):
    codes = [labels.ELSEWHERE, *a.AREA_CODES.values()]
    return metrics.page_views_wide(pv_second_region(spark, sf), codes)


def _identified(spark, sf, unit, *dims) -> DataFrame:
    """Folded hits with all four ids known, open API left out."""
    own_ids = filters.has_ids("member_id", "qz_id", "user_id")
    log = a.hits(spark, sf).where(filters.not_openapi() & own_ids)
    return a.org_hits(log, a.users(spark, sf), unit, *dims).where(filters.has_ids("instance_id"))


@query
def uv_day(spark, sf):
    counted = metrics.period_metrics(_identified(spark, sf, "day"), distinct={"num": "member_id"})
    return metrics.labelled(counted, "day", clients=True)


@query
def uv_hour(spark, sf):
    counted = metrics.period_metrics(_identified(spark, sf, "hour"), distinct={"num": "member_id"})
    return metrics.labelled(counted, "hour", clients=True)


@query
def ipv_day(spark, sf):
    counted = metrics.period_metrics(_identified(spark, sf, "day", "ip"), distinct={"num": "ip"})
    return metrics.labelled(counted, "day", clients=True)


@query
def ipv_hour(spark, sf):
    log = a.hits(spark, sf).where(filters.not_openapi())
    return metrics.labelled(metrics.distinct_per_period(log, "hour", "ip"), "hour", clients=True)


@query
def uv_day_hour_union(spark, sf):
    log = a.hits(spark, sf).where(filters.not_openapi())
    return metrics.distinct_day_and_hour(log, "member_id")


@query
def ipv_day_hour_union(spark, sf):
    log = a.hits(spark, sf).where(filters.not_openapi())
    return metrics.distinct_day_and_hour(log, "ip")


# --- enterprises and sites -----------------------------------------------------------


def _org_members(spark, sf, unit) -> DataFrame:
    log = a.hits(spark, sf).where(filters.not_openapi() & filters.has_ids("member_id"))
    folded = a.org_hits(log, a.users(spark, sf), unit)
    return folded.where(filters.has_ids("instance_id"))


@query
def ev_day(spark, sf):
    return jobs.enterprise_metrics(_org_members(spark, sf, "day"), "day")["ev"]


@query
def ev_hour(spark, sf):
    return jobs.enterprise_metrics(_org_members(spark, sf, "hour"), "hour")["ev"]


@query
def enterprise_day(spark, sf):
    return jobs.enterprise_metrics(_org_members(spark, sf, "day"), "day")["enterprise_access"]


@query
def enterprise_hour(spark, sf):
    return jobs.enterprise_metrics(_org_members(spark, sf, "hour"), "hour")["enterprise_access"]


@query
def site_day(spark, sf):
    return jobs.site_report(a.hits(spark, sf))


@query
def member_visits(spark, sf):
    log = a.hits(spark, sf).where(filters.has_ids("member_id", "qz_id"))
    visits = metrics.fold(log, "day", "qz_id", "member_id")
    return visits.withColumnRenamed(metrics.HITS, "times")


# --- key sets, weeks and months --------------------------------------------------------


def _facts(spark, sf, when=None) -> DataFrame:
    """Distinct (day, member, enterprise): folded before the enterprise is looked up."""
    events = _events(spark, sf)
    log = a.as_hits(events if when is None else events.where(when))
    known = log.where(filters.not_openapi() & filters.has_ids("member_id"))
    folded = a.org_hits(known, a.users(spark, sf), "day")
    found = folded.where(filters.has_ids("instance_id"))
    day = timebuckets.date_of_seconds("created").alias("day")
    return found.select(day, "member_id", "instance_id").distinct()


@query
def daily_distinct_fact(spark, sf):
    return _facts(spark, sf).select(_day_text("day"), "member_id", "instance_id")


def _register_key_sets() -> None:
    for unit in ("week", "month"):
        for kind, ids in key_sets.KEY_SETS.items():

            def keys(spark, sf, unit=unit, ids=ids):
                found = key_sets.period_keys(_facts(spark, sf), unit, ids)
                return found.select(_day_text("period_start"), *ids)

            QUERIES[f"{unit}_keys_{kind}"] = keys

            def so_far(spark, sf, unit=unit, ids=ids):
                facts = _facts(spark, sf)
                start = timebuckets.period_start("day", unit).alias("period_start")
                days = facts.select(start, "day").distinct()
                found = key_sets.counts_so_far(key_sets.first_days(facts, unit, ids), days)
                return found.select(_day_text("period_start"), _day_text("day"), "num")

            QUERIES[f"{unit}_{kind}_so_far"] = so_far

        for metric in ("uv", "ev"):

            def count(spark, sf, unit=unit, metric=metric):
                report = jobs.period_reports(_facts(spark, sf), unit, AS_OF)[metric]
                return report.withColumn("period_start", F.col("period_start").cast("string"))

            def paid(spark, sf, unit=unit, metric=metric):
                facts, paying = _facts(spark, sf), _payments(spark, sf)
                report = jobs.paid_period_reports(facts, paying, unit, AS_OF)[f"paid_{metric}"]
                return report.withColumn("period_start", F.col("period_start").cast("string"))

            QUERIES[f"{metric}_{unit}"] = count
            QUERIES[f"paid_{metric}_{unit}"] = paid


_register_key_sets()


def _month_keys_of_halves(spark, sf, ids) -> list[DataFrame]:
    return [key_sets.period_keys(_facts(spark, sf, half), "month", ids) for half in _halves()]


@query
def incremental_distinct(spark, sf):
    """Month keys of the first half of the data merged with those of the rest."""
    ids = key_sets.KEY_SETS["eu"]
    stored, new = _month_keys_of_halves(spark, sf, ids)
    merged = key_sets.merge_keys(stored, new)
    return merged.select(_day_text("period_start"), *ids)


@query
def incremental_append(spark, sf):
    """The same by appending only the keys not stored yet."""
    ids = key_sets.KEY_SETS["eu"]
    stored, new = _month_keys_of_halves(spark, sf, ids)
    whole = stored.unionByName(key_sets.unseen_keys(stored, new))
    return whole.select(_day_text("period_start"), *ids)


# --- paying enterprises ------------------------------------------------------------


def _payments(spark, sf) -> DataFrame:
    return a.payments(a.hits(spark, sf), a.users(spark, sf))


def _paid_folded(spark, sf) -> DataFrame:
    return _org_members(spark, sf, "day").select("created", "instance_id", "member_id").distinct()


@query
def paid_enterprises_asof(spark, sf):
    return cohort.paid_at(_payments(spark, sf), AS_OF)


@query
def paid_semi_join(spark, sf):
    kept = cohort.keep_members_of(_facts(spark, sf), _payments(spark, sf), AS_OF)
    return kept.select(_day_text("day"), "member_id", "instance_id")


@query
def paid_semi_join_range(spark, sf):
    kept = cohort.keep_paid_on_day(_paid_folded(spark, sf), _payments(spark, sf))
    return kept.select("created", "instance_id", "member_id")


def _paid_day(spark, sf) -> jobs.Reports:
    folded, paying = _paid_folded(spark, sf), _payments(spark, sf)
    return jobs.paid_day_reports(folded, paying)


@query
def paid_ev_day(spark, sf):
    return _paid_day(spark, sf)["paid_ev"]


@query
def paid_uv_day(spark, sf):
    return _paid_day(spark, sf)["paid_uv"]


# --- app events --------------------------------------------------------------------


def _app_events(spark, sf) -> DataFrame:
    return app_events.parse_events(a.app_events(spark, sf))


@query
def json_events(spark, sf):
    parsed = _app_events(spark, sf)
    return parsed.select(
        F.col("ver_code").alias("event_id"),
        "action",
        "app_id",
        "client",
        "client_ip",
        *IDENTITY_FIELDS,
        "mtime",
        "object_id",
        timebuckets.bucket("ts", "day").alias("created"),
    )


@query
def behaviour_events(spark, sf):
    """Behaviour rows need only a time; their payload is kept as it is."""
    rows = app_events.parse_behaviour(a.app_events(spark, sf))
    return rows.select(
        "mtime",
        timebuckets.bucket_of_millis("mtime", "day").alias("created"),
        F.get_json_object("payload", "$.action").alias("action"),
    )


@query
def app_normalize(spark, sf):
    normal = apps.normalize_apps(_app_events(spark, sf), a.apps(spark, sf))
    return normal.select(
        F.col("ver_code").alias("event_id"), "action", "app_id", "open_appid", "name"
    )


@query
def app_surrogate_key(spark, sf):
    registry = a.app_registry(spark, sf)
    return jobs.app_keys(_app_events(spark, sf), a.apps(spark, sf), registry)[0]


def _app_reports(spark, sf) -> jobs.Reports:
    registry = a.app_registry(spark, sf)
    return jobs.app_usage(_app_events(spark, sf), a.apps(spark, sf), registry)[1]


@query
def app_action_day(spark, sf):
    return _app_reports(spark, sf)["app_action"]


@query
def app_enterprise_day(spark, sf):
    return _app_reports(spark, sf)["app_enterprise"]


@query
def app_space_day(spark, sf):
    return _app_reports(spark, sf)["app_space"]


@query
def cohort_app_pv_uv(spark, sf):
    """Clicks of early members per day and app: requests and distinct members."""
    events = _app_events(spark, sf)
    early = filters.in_time_range("ms", 0, int(COHORT_END.timestamp() * 1000))
    timed = events.withColumn("ms", F.col("mtime").cast("bigint"))
    signups = timed.where((F.col("action") == "signup") & early)
    members = signups.select("member_id").where(filters.has_ids("member_id")).distinct()
    clicks = events.where(F.col("action").contains("click"))
    folded = metrics.fold(clicks, "day", "app_id", "member_id")
    normal = apps.normalize_apps(folded, a.apps(spark, sf))
    return metrics.period_metrics(
        cohort.keep_matching(normal, members, "member_id"),
        ["open_appid", "name"],
        distinct={"uv": "member_id"},
        sums={"pv": metrics.HITS},
    )


@query
def event_range_counts(spark, sf):
    """Purchases of one week per app, member and object."""
    low, high = 1704844800000, 1705449600000
    millis = F.col("mtime").cast("bigint")
    wanted = _app_events(spark, sf).withColumn("ms", millis)
    wanted = wanted.where(filters.in_time_range("ms", low, high) & (F.col("action") == "purchase"))
    counted = metrics.count_by(wanted, "app_id", "member_id", "object_id")
    normal = apps.normalize_apps(counted, a.apps(spark, sf))
    by_app = normal.groupBy("open_appid", "member_id", "object_id")
    return by_app.agg(F.sum("num").alias("num"))


def _object_counts(spark, sf) -> DataFrame:
    return metrics.count_by(_app_events(spark, sf), "object_id", "user_id", "action")


@query
def top_keys(spark, sf):
    return metrics.top_keys(_object_counts(spark, sf), 50, "object_id", "user_id", "action")


@query
def repeat_keys(spark, sf):
    return metrics.repeated_keys(_object_counts(spark, sf))


@query
def repeat_key_count(spark, sf):
    """How many keys repeat: one row."""
    repeated = metrics.repeated_keys(_object_counts(spark, sf))
    return repeated.agg(F.count(F.lit(1)).alias("num"))


# --- merges --------------------------------------------------------------------------


@query
def upsert_replace(spark, sf):
    """Site report as of mid-day, with the later days and that day's full numbers put over it."""
    events, report = _events(spark, sf), REPORTS["site"]
    stale = jobs.site_report(a.as_hits(events.where(F.col("ts") < timebuckets.wall_clock(SPLIT))))
    since = F.col("ts") >= timebuckets.wall_clock(datetime.combine(SPLIT_DAY, datetime.min.time()))
    fresh = jobs.site_report(a.as_hits(events.where(since)))
    return tables.merge_replace(stale, fresh, report.keys, report.values)


@query
def upsert_additive(spark, sf):
    """Wide page views of the two halves of the data added up."""
    events, people = _events(spark, sf), a.located_users(spark, sf)
    codes = [labels.ELSEWHERE, *a.AREA_CODES.values()]

    def wide(when):
        hourly = region_views(a.as_hits(events.where(when)), people, "hour")
        return metrics.page_views_wide(hourly, codes)

    before, after = _halves()
    return tables.merge_add(wide(before), wide(after), ["client_type", "created"], codes)


# --- streams ---------------------------------------------------------------------------


def _stream(spark, sf, name: str) -> DataFrame:
    return table_stream(spark, f"{sf}/{name}.parquet")


def _run(spark, stream, purpose: str, make_sink, mode: str = "append") -> str:
    """Runs a stream over all there is; returns the folder of its output."""
    out = shared_dir(spark, purpose)
    stream_jobs.run(stream, make_sink(f"{out}/data"), f"{out}/checkpoint", mode)
    return f"{out}/data"


@query
def stream_pv(spark, sf):
    """Page views per second and region: folded per batch, added up over batches."""
    people = a.located_users(spark, sf)

    def views(batch):
        counted = region_views(batch, people)
        return counted.withColumn("dt", timebuckets.date_of_seconds("created"))

    log = a.as_hits(_stream(spark, sf, "events"))
    path = _run(spark, log, "pv", lambda p: sinks.aggregated(views, sinks.append_batch(p, "dt")))
    return sinks.read_sums(spark, path, ["created", "region"])


@query
def stream_promo(spark, sf):
    lines = a.as_lines(a.as_hits(_stream(spark, sf, "events")))
    path = _run(
        spark,
        lines,
        "promo",
        lambda p: sinks.aggregated(stream_jobs.promo_counts, sinks.append_batch(p, "day")),
    )
    summed = sinks.read_sums(spark, path, ["day", "site", "r"])
    return summed.withColumn("day", F.col("day").cast("string"))


@query
def stream_uv(spark, sf):
    """Hourly UV from keys that the state store lets pass once; a batch costs what it brings."""
    log = a.as_hits(_stream(spark, sf, "events")).where(filters.not_openapi())
    fresh = stream_jobs.first_seen(stream_jobs.visitors(log), LATENESS, "created", "member_id")
    path = _run(spark, fresh.drop("ts"), "uv", lambda p: sinks.append_batch(p, "dt"))
    return metrics.count_by(spark.read.parquet(path), "created")


@query
def stream_archive(spark, sf):
    """Two outputs of one batch: the log by day, and counters per site."""
    log = archive.with_partitions(a.as_hits(_stream(spark, sf, "events"))).drop("hr")

    def site_counts(batch):
        return metrics.count_by(batch, "dt", "site")

    path = _run(
        spark,
        log.drop("net", "k", "event_type"),
        "archive",
        lambda p: sinks.both(
            sinks.append_batch(f"{p}/log", "dt"),
            sinks.aggregated(site_counts, sinks.append_batch(f"{p}/sites", "dt")),
        ),
    )
    rows = metrics.count_by(spark.read.parquet(f"{path}/log"), "dt", "site", name="archived")
    counters = sinks.read_sums(spark, f"{path}/sites", ["dt", "site"])
    return rows.join(counters, ["dt", "site"]).select(_day_text("dt"), "site", "archived", "num")


@query
def stream_access_log(spark, sf):
    """Raw lines to the enriched archive and to page views, both from one batch."""

    def dimensions(session):
        people = a.dealt(a.located_users(session, sf))
        return a.geo(people), a.sessions(people)

    lines = a.as_lines(a.as_hits(_stream(spark, sf, "events")))
    path = _run(
        spark,
        lines,
        "access",
        lambda p: stream_jobs.access_sink(
            dimensions, f"{p}/log", f"{p}/views", a.AREA_CODES, partitions=("dt",)
        ),
    )
    log = spark.read.parquet(f"{path}/log").where(filters.not_openapi())
    known = F.count_if(filters.has_identity()).alias("identified")
    rows = log.groupBy("dt").agg(F.count(F.lit(1)).alias("archived"), known)
    views = sinks.read_sums(spark, f"{path}/views", ["dt", "region"])
    return views.join(rows, "dt").select(_day_text("dt"), "region", "num", "archived", "identified")


@query
def stream_app_events(spark, sf):
    events = a.as_app_events(a.as_hits(_stream(spark, sf, "events")))
    path = _run(spark, events, "app-events", stream_jobs.app_event_sink)
    counted = metrics.count_by(spark.read.parquet(path), "dt", "action")
    return counted.select(_day_text("dt"), "action", "num")


@query
def stream_behaviour(spark, sf):
    events = a.as_app_events(a.as_hits(_stream(spark, sf, "events")))
    path = _run(spark, events, "behaviour", stream_jobs.behaviour_sink)
    stored = spark.read.parquet(path)
    counted = stored.groupBy("dt").agg(
        F.count(F.lit(1)).alias("num"), F.max("mtime").alias("last_ms")
    )
    return counted.select(_day_text("dt"), "num", "last_ms")


@query
def word_count(spark, sf):
    return stream_jobs.word_counts("text", a.table(spark, sf, "documents"))


@query
def word_count_stream(spark, sf):
    """Running counts in the state store; the last value of each word is kept."""
    running = stream_jobs.word_counts("text", _stream(spark, sf, "documents"))
    path = _run(spark, running, "words", sinks.append_batch, mode="update")
    return sinks.read_latest(spark, path, ["word"])
