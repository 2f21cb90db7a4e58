"""Batch jobs: each turns a typed log into the report tables it fills.

An access log here has ``ts, site, ip, member_id, qz_id, user_id, instance_id,
bytes_sent``; app events have ``ts, action, app_id, instance_id, qz_id, member_id``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import bytes_or_zero
from tidegauge.operators.apps import assign_app_ids, normalize_apps, with_rpid
from tidegauge.operators.cohort import keep_members_of, keep_paid_on_day
from tidegauge.operators.enrich import with_geo, with_identity
from tidegauge.operators.filters import (
    has_identity,
    has_ids,
    is_business_request,
    may_be_business_request,
    not_openapi,
)
from tidegauge.operators.joins import lookup
from tidegauge.operators.key_sets import KEY_SETS, count_keys, period_keys
from tidegauge.operators.metrics import HITS, fold, labelled, period_metrics
from tidegauge.sources.access_log import parse_lines

Reports = dict[str, DataFrame]


def enriched_log(
    lines: DataFrame, geo: DataFrame, sessions: DataFrame, unique: bool = False
) -> DataFrame:
    """Raw lines to the typed log: filter, geography without LAN traffic, identity.

    ``unique`` says that both dimensions have each key once by contract.

    The raw line ends at the filter; a hash of it spreads keyless rows in the joins, so the text
    is in no shuffle.
    """
    lines = lines.where(may_be_business_request())
    wanted = parse_lines(lines).where(is_business_request() & F.col("ts").isNotNull())
    lean = wanted.withColumn("_row", F.xxhash64("value")).drop("value")
    located = with_geo(lean, geo, spread_by=["_row"], unique=unique)
    found = with_identity(located, sessions, spread_by=["_row"], unique=unique)
    return found.drop("_row").withColumnRenamed("remote_addr", "ip")


def visitor_reports(log: DataFrame, unit: str, tz: str = "UTC") -> Reports:
    """UV and IPV. Daily IPV counts identified requests only, hourly IPV all of them."""
    site = log.where(not_openapi())
    members = fold(site.where(has_identity()), unit, "member_id", tz=tz)
    addressed = site.where(has_identity()) if unit == "day" else site
    addresses = fold(addressed, unit, "ip", tz=tz)
    return {
        "uv": labelled(period_metrics(members, distinct={"num": "member_id"}), unit, True),
        "ipv": labelled(period_metrics(addresses, distinct={"num": "ip"}), unit, True),
    }


def enterprise_reports(log: DataFrame, unit: str, tz: str = "UTC") -> Reports:
    """EV, and UV with PV per enterprise, from rows with member and enterprise."""
    known = log.where(not_openapi() & has_ids("member_id", "instance_id"))
    return enterprise_metrics(fold(known, unit, "instance_id", "member_id", tz=tz), unit)


def enterprise_metrics(folded: DataFrame, unit: str) -> Reports:
    """The same from rows folded to (bucket, enterprise, member)."""
    ev = period_metrics(folded, distinct={"num": "instance_id"})
    access = period_metrics(
        folded, ["instance_id"], distinct={"uv": "member_id"}, sums={"pv": HITS}
    )
    return {"ev": labelled(ev, unit), "enterprise_access": labelled(access, unit)}


def site_report(log: DataFrame, tz: str = "UTC") -> DataFrame:
    """UV, PV, IPV and traffic per day and site, open API included, in one pass."""
    sized = log.withColumn("traffic", bytes_or_zero("bytes_sent"))
    return site_metrics(fold(sized, "day", "site", "ip", "member_id", sums=["traffic"], tz=tz))


def site_metrics(folded: DataFrame) -> DataFrame:
    measured = period_metrics(
        folded,
        ["site"],
        distinct={"uv": "member_id", "ipv": "ip"},
        sums={"pv": HITS, "traffic": "traffic"},
    )
    return labelled(measured, "day")


def usage_of(log: DataFrame, unit: str, tz: str = "UTC") -> DataFrame:
    """One row per day or hour, site, address, member and enterprise: all that its reports need.

    A day's log is read once for this; storing it also spares the reports from
    a lost executor's part of that read.
    """
    sized = log.withColumns(
        {
            "traffic": bytes_or_zero("bytes_sent"),
            "identified": has_identity(),
        }
    )
    dims = ("site", "ip", "member_id", "qz_id", "instance_id", "identified")
    return fold(sized, unit, *dims, sums=["traffic"], tz=tz)


def usage_reports(usage: DataFrame) -> Reports:
    """The daily reports of :func:`usage_of` rows."""
    site = usage.where(not_openapi())
    visitors = site.where("identified")
    known = site.where(has_ids("member_id", "instance_id"))
    uv = period_metrics(visitors, distinct={"num": "member_id"})
    ipv = period_metrics(visitors, distinct={"num": "ip"})
    visits = period_metrics(usage.where(has_ids("member_id")), ["qz_id", "member_id"], sums={"times": HITS})
    return {
        "uv": labelled(uv, "day", True),
        "ipv": labelled(ipv, "day", True),
        "site": site_metrics(usage),
        "member_visits": visits,
        **enterprise_metrics(known, "day"),
    }


def hourly_reports(usage: DataFrame) -> Reports:
    """The same by hour, from hourly rows; hourly IPV counts all addresses."""
    site = usage.where(not_openapi())
    uv = period_metrics(site.where("identified"), distinct={"num": "member_id"})
    ipv = period_metrics(site, distinct={"num": "ip"})
    known = site.where(has_ids("member_id", "instance_id"))
    return {
        "uv": labelled(uv, "hour", True),
        "ipv": labelled(ipv, "hour", True),
        **enterprise_metrics(known, "hour"),
    }


APP_DIMS = ("action", "app_id", "instance_id", "qz_id", "member_id")


def app_keys(events: DataFrame, apps: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The registry with new apps, and ``(app_id, rpid)`` for each app id as events carry it.

    Both come from the distinct app ids, so the events themselves meet one small join.
    """
    seen = events.select("app_id").distinct().withColumn("raw", F.col("app_id"))
    named = normalize_apps(seen, apps)
    registry = assign_app_ids(named, registry)
    mapping = with_rpid(named, registry).select(F.col("raw").alias("app_id"), "rpid")
    return registry, mapping


def app_usage(
    events: DataFrame, apps: DataFrame, registry: DataFrame, tz: str = "UTC"
) -> tuple[DataFrame, Reports]:
    """The registry with new apps, and the three app reports per day."""
    folded = fold(events, "day", *APP_DIMS, tz=tz)
    registry, mapping = app_keys(folded, apps, registry)
    used = lookup(folded, mapping, "app_id", "rpid")
    return registry, app_metrics(used.where(has_ids("rpid")))


def app_metrics(used: DataFrame) -> Reports:
    keys = ["rpid", "action"]
    action = period_metrics(
        used,
        keys,
        distinct={
            "enterprise_num": "instance_id",
            "space_num": "qz_id",
            "member_num": "member_id",
        },
        sums={"num": HITS},
    )
    per = {"distinct": {"member_num": "member_id"}, "sums": {"num": HITS}}
    return {
        "app_action": action,
        "app_enterprise": period_metrics(
            used.where(has_ids("instance_id")), [*keys, "instance_id"], **per
        ),
        "app_space": period_metrics(used.where(has_ids("qz_id")), [*keys, "qz_id"], **per),
    }


def period_reports(facts: DataFrame, unit: str, as_of: date, tz: str = "UTC") -> Reports:
    """UV and EV of weeks or months up to the as-of day, from daily facts."""
    facts = facts.where(F.col("day") <= F.lit(as_of))
    members = period_keys(facts, unit, KEY_SETS["uv"])
    enterprises = period_keys(facts, unit, KEY_SETS["ev"])
    uv = count_keys(members, unit, "member_id", as_of, clients=True, tz=tz)
    ev = count_keys(enterprises, unit, "instance_id", as_of, tz=tz)
    return {"uv": uv, "ev": ev}


def paid_day_reports(
    folded: DataFrame,
    payments: DataFrame,
    first: date | None = None,
    last: date | None = None,
    tz: str = "UTC",
) -> Reports:
    """Paid EV and UV per day, each row judged by its own day's payers."""
    paid = keep_paid_on_day(folded, payments, first, last, tz)
    ev = period_metrics(paid, distinct={"num": "instance_id"})
    uv = period_metrics(paid, distinct={"num": "member_id"})
    return {"paid_ev": labelled(ev, "day"), "paid_uv": labelled(uv, "day")}


def paid_period_reports(
    facts: DataFrame, payments: DataFrame, unit: str, as_of: date, tz: str = "UTC"
) -> Reports:
    """Paid EV and UV of weeks or months up to the as-of day, by that day's payers."""
    facts = facts.where(F.col("day") <= F.lit(as_of))
    paid = keep_members_of(period_keys(facts, unit, KEY_SETS["eu"]), payments, as_of, tz=tz)
    return {
        "paid_ev": count_keys(paid, unit, "instance_id", as_of, tz=tz),
        "paid_uv": count_keys(paid, unit, "member_id", as_of, tz=tz),
    }
