"""Time expressions.

An instant is a TIMESTAMP. Buckets are formed on the wall clock of an explicit
time zone and returned as epoch seconds; nothing depends on the session zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: time format of a raw access line, inside square brackets.
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
# Text forms of days, hours and times in archives and reports.
DAY_TEXT = "yyyy:MM:dd"
DAY_TIME_TEXT = "yyyy:MM:dd:HH:mm:ss"
DAY_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"

HOUR = 3600
DAY = 86400
WEEK = 7 * DAY
# 1970-01-05 was the first Monday of the epoch.
FIRST_MONDAY = 4 * DAY
# Epoch milliseconds of the first and last day that a DATE prints with four digits, a day apart
# from the ends so that every zone's wall clock is inside.
FIRST_MILLIS, LAST_MILLIS = -62_135_510_400_000, 253_402_214_400_000
UNITS = ("second", "hour", "day", "week", "month")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_time(text: Column | str) -> Column:
    """Instant of ``[07/Jan/2017:23:59:52 +0800]``; NULL when it does not parse."""
    return F.try_to_timestamp(F.translate(_col(text), "[]", ""), F.lit(LOG_TIME))


def utc_instant(wall_clock: Column | str) -> Column:
    """Instant of a zone-less timestamp whose wall clock is UTC."""
    return F.from_utc_timestamp(_col(wall_clock).cast("timestamp"), F.current_timezone())


def _local_seconds(ts: Column, tz: str) -> Column:
    return F.unix_seconds(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def _to_epoch(local: Column, tz: str) -> Column:
    if tz == "UTC":
        return local
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), tz))


def _floor(local: Column, unit: str) -> Column:
    if unit == "second":
        return local
    if unit == "hour":
        return local - F.pmod(local, F.lit(HOUR))
    if unit == "day":
        return local - F.pmod(local, F.lit(DAY))
    if unit == "week":
        return local - F.pmod(local - F.lit(FIRST_MONDAY), F.lit(WEEK))
    if unit == "month":
        day = F.date_from_unix_date(F.floor(local / F.lit(DAY)).cast("int"))
        return F.unix_date(F.trunc(day, "month")).cast("bigint") * F.lit(DAY)
    raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")


def bucket(ts: Column | str, unit: str, tz: str = "UTC") -> Column:
    """Epoch seconds of the start of the bucket that holds ``ts``; weeks start on Monday."""
    return _to_epoch(_floor(_local_seconds(_col(ts), tz), unit), tz)


def bucket_of_seconds(seconds: Column | str, unit: str, tz: str = "UTC") -> Column:
    return bucket(F.timestamp_seconds(_col(seconds)), unit, tz)


def instant_of_millis(millis: Column | str) -> Column:
    """TIMESTAMP of epoch milliseconds; NULL outside the years 1 to 9999, never an overflow."""
    whole = _col(millis).cast("bigint")
    return F.when(whole.between(FIRST_MILLIS, LAST_MILLIS), F.timestamp_millis(whole))


def bucket_of_millis(millis: Column | str, unit: str, tz: str = "UTC") -> Column:
    return bucket(instant_of_millis(millis), unit, tz)


def coarser(created: Column | str, unit: str, tz: str = "UTC") -> Column:
    """Start of the larger bucket that holds an already computed one."""
    return bucket_of_seconds(created, unit, tz)


def millis(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts))


def day_of(ts: Column | str, tz: str = "UTC") -> Column:
    """DATE of an instant on the wall clock of ``tz``."""
    local = _floor(_local_seconds(_col(ts), tz), "day")
    return F.date_from_unix_date((local / F.lit(DAY)).cast("int"))


def date_of_seconds(seconds: Column | str, tz: str = "UTC") -> Column:
    """DATE of an epoch-second time on the wall clock of ``tz``."""
    return day_of(F.timestamp_seconds(_col(seconds)), tz)


def date_of_millis(millis: Column | str, tz: str = "UTC") -> Column:
    """DATE of an epoch-millisecond time on the wall clock of ``tz``."""
    return day_of(instant_of_millis(millis), tz)


def wall_clock(moment: datetime) -> Column:
    """A zone-less literal; a datetime literal would take the session's zone."""
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def hour_of(ts: Column | str, tz: str = "UTC") -> Column:
    """Hour of the day, 0-23, on the wall clock of ``tz``."""
    local = _local_seconds(_col(ts), tz)
    return F.floor(F.pmod(local, F.lit(DAY)) / F.lit(HOUR)).cast("int")


def period_start(day: Column | str, unit: str) -> Column:
    """First DATE of the week (Monday) or month that holds a DATE."""
    return _col(day) if unit == "day" else F.trunc(_col(day), unit).cast("date")


def day_epoch(day: Column | str, tz: str = "UTC") -> Column:
    """Epoch seconds of midnight of a DATE in ``tz``."""
    return _to_epoch(F.unix_date(_col(day)).cast("bigint") * F.lit(DAY), tz)


def day_text_epoch(text: Column | str, tz: str = "UTC") -> Column:
    """Epoch seconds of a ``yyyy:MM:dd`` day; NULL when it does not parse."""
    iso = F.replace(_col(text), F.lit(":"), F.lit("-"))
    return day_epoch(iso.try_cast("date"), tz)


def time_text(ts: Column | str, pattern: str, tz: str = "UTC") -> Column:
    """Wall clock of ``tz`` in a text pattern.

    ``convert_timezone`` gives the zone-less wall clock, so the session zone
    cancels out when the formatter reads it back.
    """
    wall = F.convert_timezone(None, F.lit(tz), _col(ts).cast("timestamp_ntz"))
    return F.date_format(wall, pattern)


def time_of_text(text: Column | str, pattern: str) -> Column:
    """Zone-less time of a text; NULL when it does not parse."""
    return F.try_to_timestamp(_col(text), F.lit(pattern)).cast("timestamp_ntz")


def is_before(a: Column | str, b: Column | str) -> Column:
    return _col(a) < _col(b)


def is_after(a: Column | str, b: Column | str) -> Column:
    return _col(a) > _col(b)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Whole seconds from ``b`` to ``a``."""
    diff = F.unix_micros(_col(a)) - F.unix_micros(_col(b))
    return (diff / F.lit(1_000_000)).cast("bigint")


def date_hour_text(ts: Column | str, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd_HH``."""
    return time_text(ts, "yyyy-MM-dd'_'HH", tz)
