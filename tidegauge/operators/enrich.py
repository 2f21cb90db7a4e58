"""Enrichment of access-log rows with geography and identity, and derived events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.ids import descramble_number
from tidegauge.functions.labels import app_of_request, client_class
from tidegauge.functions.text import (
    args_token_text,
    is_usable_token,
    request_target,
    session_cookie_text,
    url_param_text,
)
from tidegauge.functions.timebuckets import millis
from tidegauge.operators.filters import PAGE_MARK, SITE_BY_COOKIE, SITE_BY_IDS, is_lan
from tidegauge.operators.asof_join import as_of_join
from tidegauge.operators.joins import lookup
from tidegauge.schemas import EVENT_FIELDS, GEO_FIELDS, IDENTITY_FIELDS

# The two families of sessions and the API site with its own parameter name.
COOKIE_SESSIONS = "esn"
TOKEN_SESSIONS = "api"
API_SITE = "api"
API_PARAM = "access_token"
TOKEN_PARAM = "token"
OPEN_IDS = ("member_id", "qz_id", "instance_id")
# Four decimal parts, or hexadecimal groups with colons and perhaps an IPv4 tail or a zone.
IP_FORM = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|(?=[^:]*:[^:]*:)[0-9A-Fa-f:]+(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3})?(?:%[0-9A-Za-z._-]+)?)$"
CLICK = "_click"


def valid_ip(ip: Column | str) -> Column:
    """The address, or NULL when it has the form of neither IPv4 nor IPv6."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    return F.when(ip.rlike(IP_FORM), ip)


def with_geo(
    df: DataFrame,
    geo: DataFrame,
    ip: str = "remote_addr",
    spread_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Adds country, region and city by address, dropping traffic of local networks.

    ``geo`` has one row per ``ip``; if that is certain, ``unique`` saves a shuffle of it.
    """
    dim = geo.withColumnRenamed("ip", "_ip")
    valid = df.withColumn("_ip", valid_ip(ip))
    located = lookup(valid, dim, "_ip", *GEO_FIELDS, spread_by=spread_by, unique=unique).drop("_ip")
    return located.where(~is_lan(*GEO_FIELDS))


def with_geo_at(
    df: DataFrame, geo: DataFrame, ip: str = "remote_addr", at: str = "ts", **settings
) -> DataFrame:
    """The same by where the address was at the row's own time; ``geo`` has a row per ``(ip, since)``."""
    dim = geo.withColumnRenamed("ip", "_ip")
    valid = df.withColumn("_ip", valid_ip(ip))
    located = as_of_join(valid, dim, "_ip", GEO_FIELDS, at=at, **settings).drop("_ip")
    return located.where(~is_lan(*GEO_FIELDS))


def with_session(df: DataFrame) -> DataFrame:
    """Adds ``session``, the row's ``kind:token``; NULL where the site's rule finds no token.

    A token in the arguments comes before one in the query. Each text is extracted
    in a step of its own, so that the next step reads a column and does not repeat it.
    """
    request, site = F.col("request"), F.col("site")
    by_session = ~(request.contains(PAGE_MARK) | (site == SITE_BY_IDS))
    by_cookie = site == SITE_BY_COOKIE
    target = request_target(request)
    param = F.when(site == API_SITE, url_param_text(target, API_PARAM)).otherwise(
        url_param_text(target, TOKEN_PARAM)
    )
    in_args = F.when(by_session & ~by_cookie, args_token_text("request_args"))
    token = (
        F.when(by_session & by_cookie, session_cookie_text("sent_http_set_cookie"))
        .when(F.col("_args") != "", F.col("_args"))
        .when(by_session, param)
    )
    kind = F.when(by_cookie, f"{COOKIE_SESSIONS}:").otherwise(f"{TOKEN_SESSIONS}:")
    found = df.withColumn("_args", in_args).withColumn("_token", token)
    session = F.when(F.col("_token") != "", F.concat(kind, F.col("_token")))
    return found.withColumn("session", session).drop("_args", "_token")


def open_numbers(ids: Column | str) -> dict[str, Column]:
    """Scrambled INT ids of ``"qz_id=..&instance_id=..&member_id=.."``.

    All NULL unless there are exactly three parts.
    """
    ids = F.col(ids) if isinstance(ids, str) else ids
    plain = F.translate(ids, '"', "")
    whole = plain.rlike("^[^&]*&[^&]*&[^&]+&*$")

    def part(name: str) -> Column:
        number = F.regexp_extract(plain, f"(?:^|&){name}=([0-9]+)=*(?:&|$)", 1)
        return F.when(whole, number.try_cast("int"))

    return {name: part(name) for name in OPEN_IDS}


def with_open_ids(df: DataFrame, ids: str = "sent_http_set_cookie") -> DataFrame:
    """Adds member_id, qz_id and instance_id decoded from the open API's field."""
    numbers = {f"_open_{name}": number for name, number in open_numbers(ids).items()}
    decoded = {name: descramble_number(F.col(f"_open_{name}")) for name in OPEN_IDS}
    return df.withColumns(numbers).withColumns(decoded).drop(*numbers)


def with_identity(
    df: DataFrame,
    sessions: DataFrame,
    spread_by: Sequence[str] = ("value",),
    unique: bool = False,
) -> DataFrame:
    """Adds the four ids: by session lookup, or decoded in place for the open API.

    ``sessions`` has one row per ``(kind, token)``; if that is certain, ``unique`` saves a shuffle. Page requests get no ids, and
    open API requests no user id.
    """
    keyed = _keyed(df)
    dim = _session_dim(sessions)
    found = lookup(keyed, dim, "session", *[f"_{n}" for n in IDENTITY_FIELDS], spread_by=spread_by, unique=unique)
    return _with_ids(found)


def with_identity_at(
    df: DataFrame, sessions: DataFrame, at: str = "ts", spread_by: Sequence[str] = (), **settings
) -> DataFrame:
    """The same as of each row's own time: by the session that began last under its token, if that
    has not ended by then.

    ``sessions`` has a row for each ``(kind, token, since)``, and ``until`` or NULL.
    """
    dim = _session_dim(sessions, "since", "until")
    values = [f"_{n}" for n in IDENTITY_FIELDS]
    own = {"at": at, "until": "until", "spread_by": spread_by, **settings}
    return _with_ids(as_of_join(_keyed(df), dim, "session", values, **own))


def _open_names() -> list[str]:
    return [f"_open_{name}" for name in OPEN_IDS]


def _keyed(df: DataFrame) -> DataFrame:
    """Adds the row's session key and the open API's own ids."""
    page = F.col("request").contains(PAGE_MARK)
    is_open = (F.col("site") == SITE_BY_IDS) & ~page
    numbers = {
        f"_open_{name}": F.when(is_open, number)
        for name, number in open_numbers("sent_http_set_cookie").items()
    }
    return with_session(df.withColumns(numbers))


def _session_dim(sessions: DataFrame, *times: str) -> DataFrame:
    # A token with a slash is never looked up; it is cheaper to leave it out of the sessions.
    return sessions.where(is_usable_token("token")).select(
        F.concat_ws(":", "kind", "token").alias("session"),
        *[F.nullif(F.col(name), F.lit("")).alias(f"_{name}") for name in IDENTITY_FIELDS],
        *times,
    )


def _with_ids(found: DataFrame) -> DataFrame:
    # A row has a session or open ids, never both.
    ids = {
        name: F.coalesce(descramble_number(F.col(f"_open_{name}")), F.col(f"_{name}"))
        if name in OPEN_IDS
        else F.col(f"_{name}")
        for name in IDENTITY_FIELDS
    }
    return found.withColumns(ids).drop("session", *_open_names(), *[f"_{n}" for n in IDENTITY_FIELDS])


def opens_app(request: Column | str = "request") -> Column:
    """Whether :func:`derive_clicks` keeps a request; filter by it before joining identity."""
    return app_of_request(request).isNotNull()


def derive_clicks(df: DataFrame) -> DataFrame:
    """Click events of the requests that open an app, one column per event key."""
    fields = {
        "action": F.lit(CLICK),
        "app_id": app_of_request("request"),
        "client": client_class("http_user_agent"),
        "client_ip": F.col("remote_addr"),
        "device_model": F.lit(""),
        "device_name": F.lit(""),
        "mtime": millis(F.date_trunc("second", F.col("ts"))).cast("string"),
        "ver_code": F.lit(""),
        **{name: F.col(name) for name in IDENTITY_FIELDS},
    }
    clicks = df.select("ts", *[fields[n].alias(n) for n in EVENT_FIELDS if n in fields])
    return clicks.where(F.col("app_id").isNotNull())
