"""Date and time column functions.

All functions take and return :class:`pyspark.sql.Column` and stay inside
whole-stage codegen. The session clock is UTC; every shift to local wall time
is explicit.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions._util import col as _c

LOCAL_TZ = "Europe/Moscow"

# Bounds used by the reference's clean-up of timestamps and dates.
TS_FLOOR = _dt.datetime(1971, 1, 1)
TS_CEIL = _dt.datetime(2099, 12, 31, 23, 59, 59)
DATE_FLOOR = _dt.date(1900, 1, 1)
OPEN_END = _dt.date(2099, 12, 31)
OPEN_END_SOURCE = _dt.date(2299, 12, 31)

# Day-first formats tried, in order, after the ISO forms (ISO date, date-time
# with 'T' or space, optional fraction, optional zone offset) that the
# built-in cast already understands.
DAY_FIRST_FORMATS = (
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy HH:mm",
    "dd.MM.yyyy",
)


EPOCH = "1970-01-01 00:00:00"


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date/datetime, independent of the
    session time zone (a string cast; ``lit(datetime)`` would go through the
    driver's local zone)."""
    if isinstance(value, _dt.datetime):
        text = value.isoformat(" ")
    else:
        text = f"{value.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, computed on
    TIMESTAMP_NTZ values so the session time zone plays no part."""
    return F.timestamp_diff("MICROSECOND", ntz(_dt.datetime(1970, 1, 1)), _c(ts).cast("timestamp_ntz"))


def _floor_div(x: Column, d: int) -> Column:
    return F.floor(x / F.lit(d)).cast("long")


def to_local(ts, tz: str = LOCAL_TZ) -> Column:
    """UTC wall time -> local wall time (daylight rules of ``tz`` apply)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def local_date(ts, tz: str = LOCAL_TZ) -> Column:
    """Calendar date of the local wall time."""
    return F.to_date(to_local(ts, tz))


def plus_hours(ts, hours: int = 3) -> Column:
    """Fixed shift by whole hours (no daylight rules)."""
    return _c(ts) + F.make_interval(hours=F.lit(hours))


def secs(a, b) -> Column:
    """Second boundaries from ``a`` to ``b`` (dateDiff('second');
    negative when b < a)."""
    return _floor_div(epoch_micros(b), 1_000_000) - _floor_div(epoch_micros(a), 1_000_000)


def hours_floor(a, b) -> Column:
    """Whole hours from ``a`` to ``b``, truncated toward zero like intDiv."""
    return _int_div(secs(a, b), 3600)


def _int_div(x: Column, d: int) -> Column:
    """Integer division truncating toward zero (sign follows the dividend)."""
    return ((x - x % d) / d).cast("long")


def minute_boundaries(a, b) -> Column:
    """Minute boundaries crossed between ``a`` and ``b`` (dateDiff('minute'))."""
    return _floor_div(epoch_micros(b), 60_000_000) - _floor_div(epoch_micros(a), 60_000_000)


def minutes_elapsed(a, b) -> Column:
    """Elapsed minutes rounded half-even."""
    return F.bround(secs(a, b) / F.lit(60.0), 0).cast("long")


def minutes_float(a, b) -> Column:
    """Elapsed minutes as a fraction."""
    return secs(a, b) / F.lit(60.0)


def hhmmss(seconds) -> Column:
    """``HH:MM:SS`` with two-digit pads; hours of 100+ keep all digits."""
    s = _c(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", _int_div(s, 3600), _int_div(s % 3600, 60), s % 60)


def hms(seconds) -> Column:
    """``H:MM:SS`` from fractional seconds rounded half-even."""
    total = F.bround(_c(seconds).cast("double"), 0).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(total / 3600), F.floor((total % 3600) / 60), total % 60)


def fmt_ts(ts, pattern: str = "dd.MM.yyyy HH:mm:ss") -> Column:
    """X11: timestamp to text."""
    return F.date_format(_c(ts), pattern)


def fix_sec60(text) -> Column:
    """A leap second ``:60`` (with optional fraction) becomes ``:59.000``."""
    return F.regexp_replace(_c(text), r":(60)(\.\d+)?", ":59.000")


def parse_ts(text, formats=DAY_FIRST_FORMATS) -> Column:
    """Best-effort parse to UTC wall time; NULL when nothing fits (never
    raises). ISO forms go through the built-in cast: without a zone the text
    is the wall time as is; with a zone offset it is moved to UTC. Day-first
    forms are tried after it. ``coalesce`` stops at the first hit, so the
    common ISO case costs one parse."""
    t = F.trim(_c(text).cast("string"))
    zoned = t.rlike(r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    with_zone = F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                   t.try_cast("timestamp").cast("timestamp_ntz"))
    iso = F.when(zoned, with_zone).otherwise(t.try_cast("timestamp_ntz"))
    return F.coalesce(iso, *[F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in formats])


def clamp_ts(ts, floor=TS_FLOOR, ceil=TS_CEIL) -> Column:
    """Clamp to [floor, ceil]; NULL becomes the floor."""
    c = _c(ts).cast("timestamp_ntz")
    lo, hi = ntz(floor), ntz(ceil)
    return F.coalesce(F.least(F.greatest(c, lo), hi), lo)


def date_or_floor(value, floor=DATE_FLOOR) -> Column:
    """text/ts -> date; empty, NULL or unparsable -> ``floor``."""
    v = _c(value).cast("string")
    return F.coalesce(F.to_date(parse_ts(v)), F.lit(floor))


def open_end(d, source_open=OPEN_END_SOURCE, open_=OPEN_END) -> Column:
    """Open end normalised: NULL or the source's far date -> 2099-12-31."""
    c = _c(d)
    return F.when(c.isNull() | (c == F.lit(source_open)), F.lit(open_)).otherwise(c)


def latest_of(a, b) -> Column:
    """Greatest of two timestamps, NULL skipped."""
    return F.greatest(_c(a), _c(b))


def wall_time(ts) -> Column:
    """Drop the zone keeping the wall time (values are already wall time)."""
    return _c(ts).cast("timestamp_ntz")
