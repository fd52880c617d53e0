"""Epoch seconds, dates, time zones, and the interval and range codes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400
# Seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC.
MIN_EPOCH = -62_135_596_800
MAX_EPOCH = 253_402_300_799

# Unit codes of an interval ("5m", "1d") or a range ("1mo").
UNIT_CODES = {
    "m": "minute",
    "h": "hour",
    "d": "day",
    "wk": "week",
    "mo": "month",
    "y": "year",
}
# Lengths that vary, or do not start at the epoch: cut by the calendar.
CALENDAR_CODES = {"1wk": "week", "1mo": "month", "3mo": "quarter", "1y": "year"}


def _parse_code(code: str) -> tuple[int, str]:
    match = re.fullmatch(r"([1-9][0-9]*)(m|h|d|wk|mo|y)", code)
    if match is None:
        raise ValueError(f"not an interval or range code: {code!r}")
    return int(match.group(1)), UNIT_CODES[match.group(2)]


def epoch_in_range(epoch: Column) -> Column:
    return epoch.between(MIN_EPOCH, MAX_EPOCH)


def epoch_timestamp(epoch: Column) -> Column:
    """Epoch seconds to timestamp; NULL outside the years 1 to 9999."""
    return F.when(epoch_in_range(epoch), F.timestamp_seconds(epoch))


def epoch_date(epoch: Column) -> Column:
    """Epoch seconds to the UTC date, whatever the session zone is."""
    days = F.floor(epoch / SECONDS_PER_DAY).cast("int")
    return F.when(epoch_in_range(epoch), F.date_from_unix_date(days))


def epoch_text(epoch: Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` text in the session zone."""
    return F.from_unixtime(epoch)


def known_zone(zone: Column) -> Column:
    """The zone name, or NULL if there is no such zone.

    ``from_utc_timestamp`` fails the whole job on an unknown zone, so a name is first
    tried in a cast that gives NULL instead.
    """
    probe = F.concat(F.lit("1970-01-01 00:00:00 "), zone).try_cast("timestamp")
    return F.when(zone.rlike("^[A-Za-z0-9_+:/-]+$") & probe.isNotNull(), zone)


def local_date(timestamp: Column, zone: Column) -> Column:
    """The date at the exchange, in a zone from ``known_zone``; NULL without one."""
    return epoch_date(F.unix_seconds(F.from_utc_timestamp(timestamp, zone)))


def month_of(date: Column) -> Column:
    return F.trunc(date, "MM")


def run_key(timestamp: Column) -> Column:
    """Time of a landing run as a folder key."""
    return F.date_format(timestamp, "yyyyMMdd_HHmmss")


def calendar_bucket(timestamp: Column, code: str) -> Column:
    """Start of the interval a timestamp falls in.

    Minutes, hours and days are counted from the epoch; weeks start on Monday,
    months, quarters and years on their first day.
    """
    if code in CALENDAR_CODES:
        return F.date_trunc(CALENDAR_CODES[code], timestamp)
    count, unit = _parse_code(code)
    if unit in ("week", "month", "year"):
        raise ValueError(f"{code!r} has no fixed length: use one of {list(CALENDAR_CODES)}")
    return F.window(timestamp, f"{count} {unit}").getField("start")


def nests(fine: str, coarse: str) -> bool:
    """Whether every ``coarse`` interval is made of whole ``fine`` ones."""
    if fine == coarse:
        return True
    if fine in CALENDAR_CODES:
        months = {"1mo": 1, "3mo": 3, "1y": 12}
        return fine in months and coarse in months and months[fine] < months[coarse]
    seconds = _seconds(fine)
    if seconds is None:
        return False
    # Weeks, months and years begin at midnight, as days do.
    whole = _seconds("1d") if coarse in CALENDAR_CODES else _seconds(coarse)
    return whole is not None and whole % seconds == 0


def _seconds(code: str) -> int | None:
    count, unit = _parse_code(code)
    length = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}.get(unit)
    return None if length is None else count * length


def trailing_interval(code: str) -> Column:
    """A range code as an interval to subtract."""
    count, unit = _parse_code(code)
    return F.expr(f"interval '{count}' {unit}")
