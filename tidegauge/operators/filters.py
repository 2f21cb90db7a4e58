"""Row predicates as boolean Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.labels import LAN
from tidegauge.functions.text import SESSION_COOKIE, url_param_head

# Sites, static-asset marks and page mark of the request filter.
SITE_BY_COOKIE = "esn"
SITES_BY_TOKEN = ("api", "h5-api", "pc-api", "m")
SITE_BY_IDS = "openapi"
STATIC_MARKS = (".js ", ".css", ".js?", ".png", ".gif")
PAGE_MARK = ".htm"
N_FIELDS = 20


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def may_be_business_request(line: str = "value") -> Column:
    """What the filter below implies for the text alone: assets are dropped before they are split."""
    text = F.col(line)
    static = _any([text.contains(mark) for mark in STATIC_MARKS])
    return F.coalesce(text.contains(PAGE_MARK) | ~static, F.lit(False))


def is_business_request(line: str = "value") -> Column:
    """Pages always count; other requests need 20 fields, no static asset and a visitor mark.

    Applies to the output of ``parse_lines``.
    """
    text, site = F.col(line), F.col("site")
    marked = (
        F.when(site == SITE_BY_COOKIE, F.col("sent_http_set_cookie").contains(SESSION_COOKIE))
        .when(site.isin(*SITES_BY_TOKEN), text.contains("token"))
        .when(site == SITE_BY_IDS, F.lit(True))
        .otherwise(F.lit(False))
    )
    static = _any([text.contains(mark) for mark in STATIC_MARKS])
    request = (F.col("n_fields") == N_FIELDS) & ~static & marked
    return F.coalesce(text.contains(PAGE_MARK) | request, F.lit(False))


def is_promo_click() -> Column:
    """A page request with a promotion code; applies to the output of ``parse_lines``."""
    request = F.col("request")
    page = request.contains(PAGE_MARK) & request.contains("r=")
    return F.coalesce((F.col("n_fields") == N_FIELDS) & page, F.lit(False))


def promo_code(target: Column | str) -> Column:
    """Promotion code of a request target; NULL when empty."""
    return url_param_head(target, "r")


def not_openapi(site: str = "site") -> Column:
    return F.col(site) != SITE_BY_IDS


def has_ids(*names: str) -> Column:
    """All named ids are known."""
    return _all([F.col(name).isNotNull() for name in names])


def has_identity() -> Column:
    return has_ids("member_id", "qz_id", "user_id", "instance_id")


def is_lan(*names: str) -> Column:
    """Some geography text says the address is on a local network."""
    return _any([F.coalesce(F.col(n).contains(LAN), F.lit(False)) for n in names])


def in_time_range(millis: str, start_ms: int, end_ms: int) -> Column:
    """Event time from ``start_ms`` up to but not including ``end_ms``."""
    return (F.col(millis) >= start_ms) & (F.col(millis) < end_ms)
