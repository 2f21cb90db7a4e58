"""Input schemas and report-table definitions."""

from __future__ import annotations

from typing import NamedTuple

# The 20 positional fields of a raw access line, in file order.
ACCESS_FIELDS = (
    ("remote_addr", "string"),
    ("remote_user", "string"),
    ("server_addr", "string"),
    ("site", "string"),
    ("connection", "bigint"),
    ("connection_requests", "int"),
    ("request_length", "int"),
    ("time_local", "string"),
    ("msec", "decimal(17,3)"),
    ("request", "string"),
    ("request_args", "string"),
    ("status", "int"),
    ("body_bytes_sent", "bigint"),
    ("bytes_sent", "string"),
    ("http_referer", "string"),
    ("http_user_agent", "string"),
    ("http_x_forwarded_for", "string"),
    ("request_time", "double"),
    ("upstream_response_time", "double"),
    ("sent_http_set_cookie", "string"),
)

# The `key:value` fields appended to a line by enrichment, in file order.
GEO_FIELDS = ("country", "region", "city")
IDENTITY_FIELDS = ("member_id", "qz_id", "user_id", "instance_id")

# Keys of an app event; all are strings, `mtime` is epoch milliseconds.
EVENT_FIELDS = (
    "action",
    "app_id",
    "client",
    "client_ip",
    "device_model",
    "device_name",
    "instance_id",
    "member_id",
    "mtime",
    "qz_id",
    "user_id",
    "ver_code",
    "object_id",
)
EVENT_SCHEMA = ", ".join(f"{name} string" for name in EVENT_FIELDS)

REGISTRY_SCHEMA = "rpid bigint, app_id string, open_appid string, name string"

# Lookup replies wrap their payload in `result`, valid when `ecode` is "0".
IDENTITY_REPLY = (
    "ecode string, "
    "result struct<member_id string, qz_id string, user_id string, instance_id string>"
)
GEO_REPLY = "ecode string, result map<string, struct<country string, region string, city string>>"
APP_REPLY = "ecode string, result struct<app_id string, name string, open_appid string, qz_id string>"

# The period labels stored in the `type` column of report tables.
PERIOD_TYPE = {"hour": "1hour", "day": "1day", "week": "thisweek", "month": "thismonth"}
ALL_CLIENTS = "all"


class Report(NamedTuple):
    """Key and value columns of a report table."""

    keys: tuple[str, ...]
    values: tuple[str, ...]


REPORTS = {
    "uv": Report(("type", "client_type", "period_start", "created"), ("num",)),
    "ipv": Report(("type", "client_type", "created"), ("num",)),
    "ev": Report(("type", "period_start", "created"), ("num",)),
    "paid_ev": Report(("type", "period_start", "created"), ("num",)),
    "paid_uv": Report(("type", "period_start", "created"), ("num",)),
    "enterprise_access": Report(("type", "created", "instance_id"), ("uv", "pv")),
    "site": Report(("type", "site", "created"), ("uv", "pv", "ipv", "traffic")),
    "app_action": Report(
        ("created", "rpid", "action"), ("num", "enterprise_num", "space_num", "member_num")
    ),
    "app_enterprise": Report(("created", "rpid", "action", "instance_id"), ("num", "member_num")),
    "app_space": Report(("created", "rpid", "action", "qz_id"), ("num", "member_num")),
    "member_visits": Report(("created", "qz_id", "member_id"), ("times",)),
    "promo": Report(("day", "site", "r"), ("num",)),
}
