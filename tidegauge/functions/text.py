"""Text, URL and cookie expressions. All stay in the JVM; none is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# First IPv4 address, 26-character session, 40-character token.
IPV4 = r"\b(([01]?\d?\d|2[0-4]\d|25[0-5])\.){3}([01]?\d?\d|2[0-4]\d|25[0-5])\b"
SESSION_26 = r"PHPSESSID=(?=.*[a-zA-Z])(?=.*[0-9])[a-zA-Z0-9]{26}"
TOKEN_40 = r"token=(?=.*[a-zA-Z])(?=.*[0-9])[a-zA-Z0-9]{40}"
TOKEN_40_COLON = r"token:(?=.*[a-zA-Z])(?=.*[0-9])[a-zA-Z0-9]{40}"

# Fixed value: the session cookie's name.
SESSION_COOKIE = "PHPSESSID"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def first_match(c: Column | str, pattern: str, group: int = 0) -> Column:
    """First match of a pattern; NULL when there is none."""
    return blank_to_null(F.regexp_extract(_col(c), pattern, group))


def int_or_zero(c: Column | str) -> Column:
    """Whole number in ``c``; 0 for anything else."""
    c = _col(c)
    whole = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))
    return F.coalesce(whole, F.lit(0))


def bytes_or_zero(c: Column | str) -> Column:
    """Byte count in ``c`` as BIGINT; 0 for anything else."""
    c = _col(c)
    whole = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def field_count(line: Column | str) -> Column:
    """Number of tab fields, not counting empty ones at the end."""
    return F.size(F.split(F.rtrim(_col(line), F.lit("\t")), "\t"))


def request_target(request: Column | str) -> Column:
    """Path and query of ``METHOD target PROTOCOL``; '' for shorter requests."""
    return F.regexp_extract(_col(request), r"^[^ ]* ([^ ]*) +[^ ]", 1)


def _param(url: Column | str, name: str, value: str) -> Column:
    """First value of a parameter in the text between the first ``?`` and ``#``.

    One pattern for the whole URL: nested extractions would be computed repeatedly.
    """
    pattern = rf"^[^?#]*\?(?:[^#]*?&)??{re.escape(name)}={value}"
    return F.regexp_extract(_col(url), pattern, 1)


def url_param_text(url: Column | str, name: str) -> Column:
    """Value of a query parameter that has exactly one, non-empty value; else ''."""
    return _param(url, name, r"([^&=#]+)=*(?:[&#]|$)")


def url_param(url: Column | str, name: str) -> Column:
    return blank_to_null(url_param_text(url, name))


def url_param_head(url: Column | str, name: str) -> Column:
    """Text up to the next ``=`` or ``&`` of the first such parameter, '' to NULL."""
    return blank_to_null(_param(url, name, "([^&=#]*)"))


def session_cookie_text(cookie: Column | str) -> Column:
    """Session id of a ``PHPSESSID=...; path=/`` cookie; else ''."""
    head = F.split_part(_col(cookie), F.lit(" "), F.lit(1))
    return F.regexp_extract(head, rf"{SESSION_COOKIE}=([^=;]+)", 1)


def session_cookie(cookie: Column | str) -> Column:
    return blank_to_null(session_cookie_text(cookie))


def args_token_text(args: Column | str) -> Column:
    """Token in escaped JSON-like request arguments; else ''.

    Quotes arrive as ``\\x22`` and backslashes as ``\\x5C``. The first comma
    piece that mentions ``token`` must be one ``key:value`` pair.
    """
    plain = F.regexp_replace(_col(args), r'\\x22|\\x5C|"', "")
    piece = F.regexp_extract(plain, r"(?:^|,)([^,]*token[^,]*)", 1)
    value = F.regexp_extract(piece, r"^[^:]*:([^:]+):*$", 1)
    return F.translate(value, "{}", "")


def args_token(args: Column | str) -> Column:
    return blank_to_null(args_token_text(args))


def is_usable_token(token: Column | str) -> Column:
    """No slash or backslash in the token."""
    return ~_col(token).rlike(r"[/\\]")


def words(text: Column | str) -> Column:
    """Space- and line-separated words as an array."""
    return F.array_remove(F.split(_col(text), r"[ \n]+"), "")
